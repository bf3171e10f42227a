"""Composed reports, their views, and the checked query catalogue."""
