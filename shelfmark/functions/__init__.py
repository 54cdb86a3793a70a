"""Column expressions: all native, no Python on the data path."""
