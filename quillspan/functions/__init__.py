"""Column functions: text, event detectors, identifiers and turn arrays."""
