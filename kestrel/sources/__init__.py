"""Typed readers: driver tables, derived fixture views, text/CSV/JSON/XML scans, streams."""
