"""Column expressions: lateness rule, text formatting, geometry, colours."""
