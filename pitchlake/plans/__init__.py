"""Analyses, season metrics and jobs, each a function from frames to a frame."""
