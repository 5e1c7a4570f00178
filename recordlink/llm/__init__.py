"""Operators of a training-data pipeline on documents and embeddings."""
