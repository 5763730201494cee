"""Transaction mart on Spark: raw card transactions to a published star schema."""
