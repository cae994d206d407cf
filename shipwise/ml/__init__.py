"""Spark ML stages, learners, walk-forward tuning, calibration and the training job."""
