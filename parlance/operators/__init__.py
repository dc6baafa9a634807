"""Table operators: ``DataFrame -> DataFrame`` functions on built-in expressions."""
