"""Fixed values of the extractors, a module for each source."""
