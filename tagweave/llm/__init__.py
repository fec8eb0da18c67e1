"""Operators over text corpora for training data; nothing outside this folder imports them."""
