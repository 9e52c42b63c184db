"""Scans and sinks: raw CSV/JSON reads, managed tables, and the bindings to the shared tables."""
