"""Column functions: identifiers, descriptions and intensities."""
