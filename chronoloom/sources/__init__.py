"""Sources, filters and sinks."""
