"""Composed jobs and report queries."""
