"""Loads that follow what arrives."""
