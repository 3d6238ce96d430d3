"""Silver kept up to date from arriving files."""
