"""Listing pages, zip archives, CSV extracts and the keyed tables."""
