"""Column expressions: text folding, locale numbers, Spanish dates."""
