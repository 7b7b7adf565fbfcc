"""Reading raw extracts, and reading and writing layers."""
