"""Operators for preparing training data (imported by nothing else in the library)."""
