"""Basket lines to visit features to stacked class probabilities, as Spark jobs."""
