"""Independent SQL statements of what the registered queries must return."""
