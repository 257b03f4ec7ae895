"""DataFrame operators, usable on tables and on streams."""
