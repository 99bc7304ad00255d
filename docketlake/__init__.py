"""docketlake: a Spark-first engine for public-record tables and text corpora."""
