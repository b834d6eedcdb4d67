"""Scalar column expressions and named predicates."""
