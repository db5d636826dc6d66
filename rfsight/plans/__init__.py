"""Whole-table plans: the batch medallion, the observation adapter, the query catalogue."""
