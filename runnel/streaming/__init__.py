"""Metric readings: status, alerts, gauges and bounded history."""
