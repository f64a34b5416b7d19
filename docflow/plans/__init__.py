"""Whole runs: the stage registry and the registered queries."""
