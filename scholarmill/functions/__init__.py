"""Column functions: built-in expressions only, evaluated row by row inside the JVM."""
