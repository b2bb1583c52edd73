"""Column expressions: time, text, numbers, valence, stable sampling."""
