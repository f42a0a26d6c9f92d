"""Writing results: staged, checked, then published."""
