"""Frame-to-frame operators and the sinks."""
