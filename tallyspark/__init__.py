"""Spark-native data-quality, reconciliation and corpus analytics."""
