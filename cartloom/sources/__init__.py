"""Where rows come from: delimited files, Parquet folders, and star-schema tables."""
