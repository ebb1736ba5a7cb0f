"""Models, cross-validation and the whole run."""
