"""Column expressions: text converters and amount helpers."""
