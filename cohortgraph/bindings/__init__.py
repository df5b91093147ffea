"""Learner-shaped views over star-schema test tables."""
