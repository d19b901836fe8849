"""Whole models and loads composed from the operators."""
