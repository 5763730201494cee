"""DataFrame-to-DataFrame operators of the mart."""
