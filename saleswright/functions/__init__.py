"""Column expressions: text, dates, money and run parameters."""
