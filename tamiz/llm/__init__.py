"""Operators on document and page collections."""
