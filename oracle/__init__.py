"""Independent SQL for the queries, for another engine to run on the same tables."""
