"""Readers, writers and the mapping of the driver's tables to trip / zone shape."""
