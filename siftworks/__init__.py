"""siftworks: classic data mining on tables and streams, written as Spark jobs."""
