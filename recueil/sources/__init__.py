"""Readers and writers: landed pages, corpus tables, versions, journal."""
