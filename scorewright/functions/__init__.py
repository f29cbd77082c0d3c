"""Column -> Column helpers (all native Spark expressions)."""
