"""Healthcare-claims analytics expressed as plain Spark DataFrame transformations."""
