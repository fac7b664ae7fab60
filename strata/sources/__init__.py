"""Readers and writers: raw files, snapshots, layout, relational tables."""
