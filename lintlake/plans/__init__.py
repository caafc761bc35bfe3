"""End-to-end compositions and the registered queries with their SQL oracles."""
