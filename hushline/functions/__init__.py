"""Column functions: text folding, spans, context bits."""
