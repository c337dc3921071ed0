"""Column expressions: cleaning, keys, statuses and geometry, all evaluated by Catalyst."""
