"""Training-data operators over text corpora, and the queries that apply them."""
