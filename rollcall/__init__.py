"""rollcall: Spark jobs that ingest, check, store and count streams of user records."""
