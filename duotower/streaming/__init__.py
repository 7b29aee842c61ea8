"""Finite shuffled batch stream over exported shards (the reference's loader).

The reference has no unbounded source, watermark or event-time state, so no
Structured Streaming query is built here.
"""
