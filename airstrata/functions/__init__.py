"""Column expressions. All but ``pixels.resize`` stay inside the JVM."""
