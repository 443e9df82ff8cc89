"""Column expressions: text, dates, conditions, numbers, small linear algebra."""
