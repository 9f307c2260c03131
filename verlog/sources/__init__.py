"""Storage side: the versioned table (change log + history), temp views, driver-table readers."""
