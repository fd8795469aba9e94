"""Column functions: text, typing, normalization, checks, units, identity."""
