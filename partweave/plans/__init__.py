"""Composite plans: the integration pipeline, the fixture and the query catalog."""
