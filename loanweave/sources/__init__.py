"""Table registry, readers, writers and staging."""
