"""Operators on panels: plain ``DataFrame -> DataFrame`` functions."""
