"""Spark-native processing of equipment quality-control workbooks."""
