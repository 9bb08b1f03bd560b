"""Column functions: text and paths, geometry, labels, class maps."""
