"""End-to-end flows and the query catalogue over the shared tables."""
