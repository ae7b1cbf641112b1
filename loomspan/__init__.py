"""Traces of coding agents, from logs to training data, on Spark."""

__version__ = "0.1.0"
