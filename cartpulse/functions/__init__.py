"""Column builders. Every formula of the library is written here once."""
