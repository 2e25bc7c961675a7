"""Readers for stored tickets and landed provider pages."""
