"""Registered queries and table bindings."""
