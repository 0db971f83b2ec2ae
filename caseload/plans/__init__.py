"""Composed workflows, stage materialization and the query registry."""
