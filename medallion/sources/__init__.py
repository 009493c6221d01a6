"""Readers (declared schemas, permissive parsing) and sinks."""
