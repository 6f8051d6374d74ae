"""Distributed fit and score of the activity model, and its version registry."""
