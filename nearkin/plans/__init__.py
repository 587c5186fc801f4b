"""Whole jobs: read, compute, write."""
