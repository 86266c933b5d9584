"""Streaming wrappers: the row-local operators on ``readStream``."""
