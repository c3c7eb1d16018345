"""Music-library analytics as Spark jobs: ingest, pooling, scenario queries, similarity, setlists."""
