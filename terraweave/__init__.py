"""Geo-entity tables to subject-predicate-object rows, by Spark's own operators."""
