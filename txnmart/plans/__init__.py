"""The mart's jobs, composed from the operators."""
