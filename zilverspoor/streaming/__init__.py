"""Incremental landing of part files."""
