"""Operators for training data: text forms, quantile sketches, tokens, packing, language labels."""
