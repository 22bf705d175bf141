"""Column expressions, column selection and aggregate measures."""
