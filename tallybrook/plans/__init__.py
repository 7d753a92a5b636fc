"""Whole jobs that compose the operators, and sinks for their results."""
