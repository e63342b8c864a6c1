"""Subpackage of busframe."""
