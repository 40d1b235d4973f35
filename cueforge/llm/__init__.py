"""Training-data operators over document tables (see the README for the list)."""
