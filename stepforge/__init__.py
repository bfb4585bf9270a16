"""Trajectory analytics and sample curation as Spark DataFrame operators."""
