"""Session analytics as Spark jobs: every operator maps DataFrames to DataFrames."""
