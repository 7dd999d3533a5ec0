"""Relational steps on readings, daily, weekly and seasonal tables."""
