"""Plans: the data products assembled from sources, operators and sinks."""
