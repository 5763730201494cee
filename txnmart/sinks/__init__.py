"""Where results go: the versioned mart folder and relational databases."""
