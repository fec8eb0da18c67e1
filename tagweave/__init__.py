"""Audience metrics and lexicon tagging of posts, as plain Spark DataFrames."""
