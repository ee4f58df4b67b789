"""Scans of relational databases and warehouse tables."""
