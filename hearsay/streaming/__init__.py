"""Continuous jobs: the batch operators inside micro-batches."""
