"""Operators over traces, logs, assessments and evaluation datasets."""
