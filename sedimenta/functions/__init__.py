"""Column expressions: text to typed values, calendar attributes, guarded measures."""
