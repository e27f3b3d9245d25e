"""Scans, sinks and source adapters."""
