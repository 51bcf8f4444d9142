"""Scans of tables, events and logs, and the table writes."""
