"""Relational operators over raw, validated, curve and snapshot tables."""
