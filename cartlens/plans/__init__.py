"""Composite jobs (feature sets, models, A/B scoring), the query registry and its oracle."""
