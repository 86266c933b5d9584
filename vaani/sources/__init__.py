"""Readers and writers (K1-K4)."""
