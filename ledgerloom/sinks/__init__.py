"""Where results go: audited tables, the import and exception files, and the run log."""
