"""Column functions: dates, JSON, text, arrays and numbers. All run inside the JVM."""
