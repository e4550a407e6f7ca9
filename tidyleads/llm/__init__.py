"""Training-data operators on Spark.  Nothing outside this subpackage (but for
the guarded hook in ``__spark_entry__`` and ``corpus_pipeline``) imports it."""
