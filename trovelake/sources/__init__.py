"""Where catalogue tables, request documents and content come from and go."""
