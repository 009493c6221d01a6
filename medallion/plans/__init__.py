"""Cleaning flows and registered queries."""
