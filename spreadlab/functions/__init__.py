"""Column functions: JVM-side expressions only, except the name-similarity scorer."""
