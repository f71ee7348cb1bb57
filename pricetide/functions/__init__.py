"""Column expressions: price text, discounts, HTML fields."""
