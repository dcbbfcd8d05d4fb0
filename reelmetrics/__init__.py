"""Batch analytics for a subscription video service, written for Spark."""
