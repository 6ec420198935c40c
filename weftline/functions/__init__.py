"""Column builders: pure expressions without actions."""
