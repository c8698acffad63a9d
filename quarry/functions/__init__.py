"""Column-expression builders (inventory group H); all JVM-side, no Python UDFs."""
