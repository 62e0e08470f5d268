"""Relational operators over tournament documents."""
