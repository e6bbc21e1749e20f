"""Table maintenance, run log, comparison and quality operators."""
