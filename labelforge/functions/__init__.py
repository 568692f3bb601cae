"""Column-level helpers: every function returns a ``Column`` built from built-ins."""
