"""Readers: landed pages, stored documents, message topics."""
