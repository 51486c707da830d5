"""roadlake: road-network and geospatial feature tables as ordinary Spark jobs."""
