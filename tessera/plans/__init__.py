"""Layered pipelines composed of operators."""
