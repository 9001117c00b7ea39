"""Reading and writing: entity tables, registry, audit log, staging."""
