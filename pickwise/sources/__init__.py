"""Scans, stand-in tables and sinks."""
