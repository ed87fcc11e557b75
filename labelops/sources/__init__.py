"""File scans, report readers and sinks."""
