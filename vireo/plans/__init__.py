"""Composite analyses and the registry of runnable queries."""
