"""Column helpers. Everything here is a built-in expression, so it stays in codegen."""
