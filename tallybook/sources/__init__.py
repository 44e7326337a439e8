"""Declared schemas, readers and table publishing."""
