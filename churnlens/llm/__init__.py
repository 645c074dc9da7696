"""Operators for preparing large text corpora; nothing outside imports this."""
