"""Staged inputs: paged JSON entities, text CSV masters, stored tables and date rows."""
