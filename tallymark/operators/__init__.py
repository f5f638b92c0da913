"""DataFrame-to-DataFrame steps the pipelines are made of."""
