"""Railtide: punctuality analytics for public-transport stop events, built on PySpark."""
