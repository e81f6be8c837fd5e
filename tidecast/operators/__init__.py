"""Relational operators: normalise, flatten, aggregate, latest state, collections and fact tables."""
