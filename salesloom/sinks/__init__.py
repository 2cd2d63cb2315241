"""Writers for processed output."""
