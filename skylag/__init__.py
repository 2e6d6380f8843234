"""Delay and weather analytics as Spark DataFrame operators."""
