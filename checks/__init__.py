"""Verification on the driver's tables: logistics-shaped feeds, registered queries and their SQL twins."""
