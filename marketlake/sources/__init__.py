"""Landed files and payloads."""
