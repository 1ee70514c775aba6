"""Scorecard engine on Spark: validate, encode, profile, train, evaluate and score snapshots."""
