"""Column functions: text, lexicons, scores. Each takes and returns ``Column``s."""
