"""Column expressions: text and time helpers, validation rules, person attributes."""
