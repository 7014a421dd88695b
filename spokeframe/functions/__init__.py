"""Column builders made of built-in functions only."""
