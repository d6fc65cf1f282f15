"""Interaction analytics and recommendation as Spark DataFrame functions."""
