"""Readers, writers and document ingest."""
