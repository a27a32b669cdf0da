"""Relational idioms: de-duplication, matching, reshaping and history resolution."""
