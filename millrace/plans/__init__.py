"""Whole runs: fact load, dimension load and manifest."""
