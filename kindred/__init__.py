"""Audience expansion on Spark: populations, features, embeddings, classifiers and selection as DataFrame operators."""
