"""Queries over the driver's tables and the SQL that answers them independently."""
