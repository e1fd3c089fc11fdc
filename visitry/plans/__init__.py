"""Pipelines composed of the operators: event loading, reports, dashboards, models."""
