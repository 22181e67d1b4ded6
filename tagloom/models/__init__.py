"""Ratings, preference models, recommendation lists and buyer segments."""
