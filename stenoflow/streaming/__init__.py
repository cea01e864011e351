"""Streaming twins of the status and timeline operators."""
