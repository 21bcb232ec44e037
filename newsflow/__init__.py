"""Spark-native curation of news tables: extract, deduplicate, land, analyse, track."""
