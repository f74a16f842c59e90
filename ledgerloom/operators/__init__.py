"""Operators that hold when one key, one group or one set of copies carries a large share of all rows."""
