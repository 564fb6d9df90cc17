"""Readers, adapters from the driver's tables, and sinks."""
