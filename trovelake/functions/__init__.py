"""Column-to-column functions; a failure gives NULL, never an exception."""
