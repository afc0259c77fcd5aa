"""Operators for preparing training text at scale; nothing else in tagmill imports this subpackage."""
