"""Part of the table engine."""
