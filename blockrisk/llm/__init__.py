"""Training-data operators over tables of documents, vectors and conversations."""
