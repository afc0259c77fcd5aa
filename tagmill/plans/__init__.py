"""Queries by area; importing this package's modules fills the register."""
