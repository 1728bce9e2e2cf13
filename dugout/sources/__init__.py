"""Landed files, pages and payloads in; tables out; fixed code tables."""
