"""Readers of landed files. All of them are lazy multi-file scans."""
