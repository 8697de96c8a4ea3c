"""The same steps on file streams."""
