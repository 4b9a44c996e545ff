"""Table schemas, readers and sinks."""
