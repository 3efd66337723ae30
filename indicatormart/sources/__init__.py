"""Readers, sinks, raw schemas and the test-table stand-ins."""
