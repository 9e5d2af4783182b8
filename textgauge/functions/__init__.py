"""Column expressions: text, n-grams, multisets, vectors, prompts."""
