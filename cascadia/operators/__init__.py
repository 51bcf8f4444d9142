"""Rollout operators: filters, joins, aggregates, graph, lifecycle, votes."""
