"""Readers and writers: site files, report files, staged tables."""
