"""Structured Streaming entry points.

The reference has no streaming jobs; these wrappers only show that the
DataFrame operators run unchanged on a streaming source.
"""
