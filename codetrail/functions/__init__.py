"""Column-expression building blocks (all JVM built-ins, codegen friendly)."""
