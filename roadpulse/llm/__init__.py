"""Operators and queries for preparing text corpora; nothing else imports this package."""
