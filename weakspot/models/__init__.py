"""Spark ML estimators, feature votes, searches, ensembles, attributions."""
