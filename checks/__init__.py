"""Independent SQL for the registered queries, and the comparison of both."""
