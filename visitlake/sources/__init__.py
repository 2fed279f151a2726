"""Typed reads, exports and the star model."""
