"""Operators for training-data pipelines. Nothing else in terrasift imports this package."""
