"""Composite plans: star schemas, the page scrape, end-to-end ETL runs and test fixtures."""
