"""Column expressions. All are JVM built-ins, so they stay inside whole-stage code generation."""
