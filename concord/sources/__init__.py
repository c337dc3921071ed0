"""Reading published pages and metadata, and writing tables under a contract."""
