"""Every operator and report on a set of general tables, with SQL to compare."""
