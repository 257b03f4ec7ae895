"""Column expressions: text, numbers, times, status and live values."""
