"""Column functions: casts, JSON text, lists, dates. All JVM-side expressions."""
