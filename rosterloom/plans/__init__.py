"""Dataset jobs and analytical queries."""
