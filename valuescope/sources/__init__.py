"""Sources: text/CSV lines, versioned parquet, profile folders, archives, media."""
