"""Readers of landed assets, writers of exports, and the catalog tables."""
