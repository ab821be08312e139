"""Readers: tagged-record CSV, CSV inside (nested) ZIP archives, columnar JSON."""
