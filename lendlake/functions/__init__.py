"""Column expressions and small date helpers; all of them run inside the JVM."""
