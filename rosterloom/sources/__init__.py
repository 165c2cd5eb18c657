"""Panel schema, scans and sinks."""
