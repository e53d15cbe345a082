"""DataFrame -> DataFrame transforms, one module per area."""
