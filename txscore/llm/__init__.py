"""Operators for training data: each module is one operator, `queries` applies them."""
