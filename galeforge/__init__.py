"""Ensemble-hazard analytics as Spark DataFrame plans."""
