"""Training-data operators: ten operators over documents, pages and embeddings, each by its own method."""
