"""Sources: month-file discovery, CSV loading, driver test-table mapping, sampling."""
