"""Column functions: name and value normalisation, staging codecs."""
