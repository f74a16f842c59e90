"""Procure-to-pay data quality, master data and three-way match as Spark DataFrame jobs."""
