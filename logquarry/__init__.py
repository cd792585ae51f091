"""Batch operators for audit-log analytics, anomaly models and text retrieval on Spark."""
