"""Queries composed from the operators: history, export, dashboard, and the registered query set."""
