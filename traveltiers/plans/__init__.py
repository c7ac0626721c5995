"""Layer wiring, the pipeline runner and the registered queries with their SQL oracles."""
