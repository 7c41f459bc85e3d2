"""Readers, table sinks and the mapping of the test tables onto the domain model."""
