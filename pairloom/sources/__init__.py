"""Scans, adapters, caches and sinks."""
