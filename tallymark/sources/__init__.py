"""Scans: files with envelopes, tables with declared columns, marked-up pages, remote answers."""
