"""Column functions: path pieces, lexicon patterns, dimension rules."""
