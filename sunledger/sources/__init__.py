"""Table scans, sinks and the solar view of an events table."""
