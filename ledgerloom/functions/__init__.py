"""Column expressions. All of them stay inside the JVM: no Python UDF in this package."""
