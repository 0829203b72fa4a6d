"""Sources: raw scraper envelopes, lakehouse tables, driver-table fixtures."""
