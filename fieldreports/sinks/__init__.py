"""Writers: CSV reports, table versions, insert-only appends."""
