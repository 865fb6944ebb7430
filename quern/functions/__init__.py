"""Subpackage of quern."""
