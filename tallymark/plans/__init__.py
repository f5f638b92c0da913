"""The three pipelines: one module per statement layout, each with an export and its statistics."""
