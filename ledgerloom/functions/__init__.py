"""Column functions: ids, numbers, time, status vocabularies."""
