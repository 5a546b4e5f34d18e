"""Sources: streams, lake, files, dimensions and layer tables."""
