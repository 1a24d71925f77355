"""Indicators and the report, composed from the operators."""
