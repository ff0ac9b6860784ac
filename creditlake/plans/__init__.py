"""Silver, gold and end-to-end plans built from the operators."""
