"""Sources: JSON landing files (batch and stream), the warehouse table,
CSV extracts, and the adapter from the test ``events`` table."""
