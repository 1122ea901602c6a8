"""Promotion, quota, commission and click analytics as Spark DataFrame operators."""
