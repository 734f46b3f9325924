"""Column expressions: numbers, dates, text, card attributes."""
