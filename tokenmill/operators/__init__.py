"""DataFrame operators: statistics, training, codecs, windows, vectors."""
