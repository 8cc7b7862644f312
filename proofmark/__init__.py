"""Data layer for evaluating language-model applications, as Spark jobs.

Traces, request logs, assessments and evaluation datasets are ordinary DataFrames; every operator
takes DataFrames and returns a DataFrame, so plans stay lazy and Catalyst sees them whole.
"""
