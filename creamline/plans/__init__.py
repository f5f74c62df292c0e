"""Reports composed of the operators. Each takes a mapping of table name to DataFrame."""
