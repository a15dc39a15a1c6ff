"""Operators for preparing training text: near-copies, quality, language, mixing."""
