"""Jobs that run on a schedule, and the queries over the shared tables."""
