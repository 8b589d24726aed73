"""Column functions; every one stays inside whole-stage code generation."""
