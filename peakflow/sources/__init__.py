"""Readers for raw exports and dimension tables, writers for results, staged hand-over tables."""
