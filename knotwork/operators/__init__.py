"""Operators over vertex, edge, person, flat and conversation tables."""
