"""Column expressions: built-ins only, so every one stays inside generated code."""
