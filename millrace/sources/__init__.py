"""Scans, file streams, schema conformance and the synthetic batch generator."""
