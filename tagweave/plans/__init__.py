"""The two jobs from input tables to written results."""
