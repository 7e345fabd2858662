"""Spark-first analytics engine for sequence-assembly tables."""
