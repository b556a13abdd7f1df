"""Landing files and tables."""
