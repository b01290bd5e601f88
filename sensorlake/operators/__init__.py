"""DataFrame -> DataFrame operators: cleaning, derivation, de-duplication,
reports and data-quality checks."""
