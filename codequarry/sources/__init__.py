"""Scans: repository lists, archives, record files and the language catalog."""
