"""Spark jobs that keep customer-activity features, scores and drift checks up to date."""
