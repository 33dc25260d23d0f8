"""termweave: terminology and entity-linking resources built with Spark DataFrames."""
