"""Operators for preparing text and vectors for training, on documents, labels and embeddings."""
