"""Match analytics as Spark jobs: flatten, aggregate, stream, explain."""
