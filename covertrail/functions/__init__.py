"""Column functions: masks and remaps, legends, spectral indices."""
