"""Readers and writers: landing files, tables, message streams, scan dumps."""
