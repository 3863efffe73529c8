"""Whole jobs: operators between stored tables."""
