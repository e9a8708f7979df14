"""Views over the input tables, the query catalogue and the full report job."""
