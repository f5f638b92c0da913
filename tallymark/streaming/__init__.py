"""Files that keep arriving."""
