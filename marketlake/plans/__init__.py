"""Operators put together: table versions, load plans."""
