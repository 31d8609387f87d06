"""The three composed jobs."""
