"""Queries of the core package and their SQL."""
