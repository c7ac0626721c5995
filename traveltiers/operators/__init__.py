"""DataFrame -> DataFrame operators for each layer, ranking and quality checks."""
