"""Spark-native curation of speech transcripts, manifests and training text."""
