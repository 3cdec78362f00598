"""Column functions: value conversions and the change-record text format."""
