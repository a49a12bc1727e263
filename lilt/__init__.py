"""Prosody annotation and calibration expressed as Spark DataFrames."""
