"""Mapping rules and the batch job."""
