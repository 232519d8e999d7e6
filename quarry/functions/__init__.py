"""Column-expression builders (JVM-side, codegen-friendly) and type helpers."""
