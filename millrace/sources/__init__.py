"""Configured readers, message-log selection, schemas and file scans."""
