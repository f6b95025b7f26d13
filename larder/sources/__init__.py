"""Static dimensions, scans and sinks."""
