"""Operators for preparing language-model training corpora, as Spark jobs."""
