"""Column functions for raw documents."""
