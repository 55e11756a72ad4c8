"""Column functions: text clean-up, tokens, key phrases, vectors, stemming."""
