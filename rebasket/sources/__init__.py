"""Reading raw files and writing tables, exports and feature stores."""
