"""Column-expression functions (calendar, encoders, rules)."""
