"""Spark-native analytics for telescope surveys: matching, calibration, history, classification, streams."""
