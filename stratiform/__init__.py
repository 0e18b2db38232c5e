"""Layered analytics tables on Spark: land, stage, type, bridge, model, score and audit.

Every operator takes and returns DataFrames, so Catalyst sees one declarative plan from file to report.
"""
