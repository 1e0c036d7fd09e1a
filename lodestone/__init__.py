"""Lodestone: incremental indexing and hybrid search of text corpora as Spark jobs."""
