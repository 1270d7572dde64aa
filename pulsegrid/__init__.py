"""Spark-native processing of operational metrics.

A measurement is a timestamp, a name, a map of tags and a map of numeric fields.
The package decodes, normalises, enriches, stores and summarises measurements with
ordinary DataFrame and Structured Streaming code.
"""

from pulsegrid.schema import MEASUREMENT

__all__ = ["MEASUREMENT"]
