"""Sources and sinks: fixture projection, file scans, writers."""
