"""Independent SQL for the registered queries, on the base tables."""
