"""Query plans: the semantic layer (views) and the registry of test-data queries."""
