"""Outputs: the enriched export and the statistics log."""
