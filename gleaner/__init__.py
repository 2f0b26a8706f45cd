"""Corpus analytics on Spark DataFrames: words, features, labels, slots, topics and summaries."""
