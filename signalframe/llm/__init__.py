"""Operators on the text corpus and on groups of copies of a record; nothing outside this subpackage imports it."""
