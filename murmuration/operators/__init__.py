"""DataFrame -> DataFrame operators with plain column names."""
