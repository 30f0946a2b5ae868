"""The staged pipeline, its run ledger and the query catalogue."""
