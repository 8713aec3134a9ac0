"""Retail event routing on Spark: log splitting, change-stream routing, wide orders, daily actives."""
