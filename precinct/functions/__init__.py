"""Column expressions (no Python UDFs): dates, geography, text."""
