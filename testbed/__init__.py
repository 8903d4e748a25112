"""Checks of the package on the given tables: adapter, registered queries, SQL to compare with."""
