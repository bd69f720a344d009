"""Column expressions (JVM-side, codegen friendly)."""
