"""Incremental folder intake."""
