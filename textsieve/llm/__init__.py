"""Operators for training data, each on its own: nothing else in the library imports them."""
