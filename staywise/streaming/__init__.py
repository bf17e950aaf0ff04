"""Chained streams over file tables, and the streaming scorer."""
