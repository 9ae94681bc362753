"""Registry, readers and adapters."""
