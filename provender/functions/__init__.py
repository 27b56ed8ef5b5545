"""Column-level building blocks: text, dates and value typing."""
