"""Readers and writers of the pipeline's tables, and connectors with an interface for what fetches pages."""
