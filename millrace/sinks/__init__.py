"""Writers for files, databases, document and graph stores. All overwrite by default."""
