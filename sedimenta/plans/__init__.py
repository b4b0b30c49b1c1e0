"""Whole runs built from the operators."""
