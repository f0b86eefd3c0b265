"""Column functions: Column -> Column, evaluated in the JVM."""
