"""DataFrame -> DataFrame operators: gates, shape, split, quality, gold, observe."""
