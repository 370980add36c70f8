"""Column functions. All of them are compositions of built-in expressions."""
