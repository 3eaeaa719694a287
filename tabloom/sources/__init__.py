"""Readers, sinks and the derived car table."""
