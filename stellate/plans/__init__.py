"""Composed jobs: star build, loads, reports, error log, job registry."""
