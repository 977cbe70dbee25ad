"""Marketplace analytics on Spark: cleaning, audit, KPIs, features, models, streams."""

__version__ = "0.1.0"
