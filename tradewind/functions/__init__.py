"""Column expressions: scalars, money and time."""
