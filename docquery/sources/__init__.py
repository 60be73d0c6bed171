"""Sessions over a folder of tables."""
