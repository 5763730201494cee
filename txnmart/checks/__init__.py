"""The operators applied to the supplied test tables, and the SQL that must agree."""
