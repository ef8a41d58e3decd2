"""Readers, sinks and the versioned table layout."""
