"""Composite verbs (silver build, reconcile, gold build, backfill, universe
plan) and the registered query catalogue."""
