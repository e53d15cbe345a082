"""Readers for landed data and the adapter over the shared test tables."""
