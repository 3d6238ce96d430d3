"""Readers, sinks and the path convention."""
