"""Whole plans: the batch report, and the bindings to the test tables."""
