"""Whole layers and reports, composed from the operators."""
