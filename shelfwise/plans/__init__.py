"""Composed workflows (tag features, recommendations) and the query catalog."""
