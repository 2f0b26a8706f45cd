"""Reading and writing corpora, and staging intermediate tables."""
