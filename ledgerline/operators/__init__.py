"""Reusable relational shapes, data-quality checks and calendars."""
