"""Column builders. Nothing here reads or writes data."""
