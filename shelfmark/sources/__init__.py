"""Stored layers, partner tables, exports and object folders."""
