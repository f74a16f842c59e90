"""Other schemas presented as staged procure-to-pay tables."""
