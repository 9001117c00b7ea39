"""DataFrame operators: rule application, uniqueness, counting, validation."""
