"""Sustainability indicators over long scenario tables, as lazy Spark DataFrame plans."""
