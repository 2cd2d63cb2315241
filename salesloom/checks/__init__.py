"""Registered queries over the order tables, and the SQL each must agree with."""
