"""Readers that produce document tables, and writers for the results."""
