"""Composite operators: classifying attributes, audiences, metrics, tagging."""
