"""Change-rollout analytics as plain functions from DataFrames to DataFrames."""
