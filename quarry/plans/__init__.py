"""Composed jobs: config-driven ETL plans and the registered query catalog."""
