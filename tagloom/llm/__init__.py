"""Operators of a training-data pipeline: documents in, decisions, links, shards or sequences out."""
