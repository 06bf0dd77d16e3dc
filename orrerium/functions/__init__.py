"""Column expressions: identifiers, dates, text and weights. All stay in the JVM unless their docstring says otherwise."""
