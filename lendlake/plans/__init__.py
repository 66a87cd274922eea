"""Whole jobs: backfills, modelling and monitoring on the store, and the query registry."""
