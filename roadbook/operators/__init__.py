"""Table operators: each one is a lazy ``DataFrame -> DataFrame`` function."""
