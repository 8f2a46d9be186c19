"""Operators for preparing a text corpus. Nothing else in the package imports from here."""
