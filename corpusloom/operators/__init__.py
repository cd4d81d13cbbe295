"""Relational and order-sensitive operators."""
