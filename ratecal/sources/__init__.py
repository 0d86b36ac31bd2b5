"""Reading collections of quote documents and writing tables."""
