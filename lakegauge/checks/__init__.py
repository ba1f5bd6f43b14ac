"""Checks of the library over whole tables: queries, and the SQL giving the same rows."""
