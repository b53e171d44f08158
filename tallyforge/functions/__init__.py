"""Shared column expressions."""
