"""Column expressions: every helper takes and returns ``Column`` and runs on the JVM."""
