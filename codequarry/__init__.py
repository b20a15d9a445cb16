"""Curation of source-code archives into a deduplicated text corpus, as Spark DataFrame jobs."""
