"""Record sinks."""
