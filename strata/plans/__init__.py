"""Domain jobs composed from the operators: each ``build(...)`` takes input
DataFrames and returns the silver/gold DataFrames; nothing writes unless a
sink from ``strata.sources.lake`` is called."""
