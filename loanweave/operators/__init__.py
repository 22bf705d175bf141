"""Profiles, cleaning, checks, roll-ups, joins and model training."""
