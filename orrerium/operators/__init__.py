"""Relational operators that Spark has no single primitive for, as compositions of DataFrame operations."""
