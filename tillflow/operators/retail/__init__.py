"""Sales analysis over overlapping retail extracts."""
