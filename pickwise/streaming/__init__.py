"""Micro-batch serving of new demands."""
