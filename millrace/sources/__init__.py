"""Scans: files, JDBC and already written zones or tables."""
