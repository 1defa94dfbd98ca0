"""Column -> Column expressions (JVM-side, inside whole-stage codegen)."""
