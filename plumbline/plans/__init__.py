"""Whole flows: onboarding, runs and reports."""
