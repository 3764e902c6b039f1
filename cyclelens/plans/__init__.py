"""What to compute: the catalogue of reports and the end-to-end jobs."""
