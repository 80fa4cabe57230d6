"""Spark-native polygenic scoring and evidence grading."""
