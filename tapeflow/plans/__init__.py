"""Boards and the registered queries."""
