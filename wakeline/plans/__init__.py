"""Composite pipelines: landing, business and serving layers, radar, metrics and reports."""
