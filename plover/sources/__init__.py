"""Scans, CSV, versioned snapshots, catalog tables and schema tables."""
