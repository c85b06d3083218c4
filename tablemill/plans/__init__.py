"""Reports and whole flows composed from the operators."""
