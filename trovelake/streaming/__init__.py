"""Request streams and change streams."""
