"""Column expressions and range-partitioned running sums."""
