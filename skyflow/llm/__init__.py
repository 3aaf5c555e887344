"""Operators for training-data pipelines. Nothing else in the library imports this package."""

from skyflow.llm import registry

queries = registry.queries
oracle_sql = registry.oracle_sql
