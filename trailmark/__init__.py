"""Clickstream quality, cleaning, attribution, marts and monitoring as Spark DataFrame transformations."""
