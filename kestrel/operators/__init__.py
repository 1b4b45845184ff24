"""Relational building blocks composed from DataFrame operations."""
