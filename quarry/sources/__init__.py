"""Readers (format tables, schema files, paged JSON) and writers."""
