"""Sources: typed readers, source-name resolution, and derived test sources."""
