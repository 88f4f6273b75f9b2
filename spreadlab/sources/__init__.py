"""Reading feeds: explicit schemas, dated files, file state."""
