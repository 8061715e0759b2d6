"""Batch analytics for video-streaming usage data, written for Spark."""
