"""Readers and writers: topics, Bronze, Silver, Gold, landing files, vendor data."""
