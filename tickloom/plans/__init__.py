"""Monitoring, gates, reports and alerts built from the operators."""
