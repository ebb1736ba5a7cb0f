"""Column expressions, quantiles, positions/running totals and size checks."""
