"""Reports: the operators composed into the tables that are published."""
