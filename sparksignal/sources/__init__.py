"""Landed files and raw records as typed tables, and table sinks."""
