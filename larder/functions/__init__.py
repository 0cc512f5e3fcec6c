"""Column expressions: no actions, no shuffles, everything inside the JVM except image kernels."""
