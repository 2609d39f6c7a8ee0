"""Column expressions: calendar grid, scalar rules, request and image urls."""
