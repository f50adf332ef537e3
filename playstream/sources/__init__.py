"""Sources, fixtures derived from the given tables, and sinks."""
