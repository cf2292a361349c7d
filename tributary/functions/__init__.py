"""Column functions: strict text casts and grade arithmetic."""
