"""Incremental bronze: the batch bronze operators applied to a growing file folder."""
