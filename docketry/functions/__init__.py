"""Column expressions: text, numbers, time, scores. All of them run inside the JVM."""
