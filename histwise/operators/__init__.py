"""Relational operators built from DataFrame primitives."""
