"""Search-log shaped tables derived from the given test tables."""
