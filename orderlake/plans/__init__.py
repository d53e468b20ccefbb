"""Composed plans: the query registry, its SQL twins and the daily job."""
