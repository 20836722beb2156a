"""PySpark jobs for a reader / book / rating data set: files in, keyed messages out,
micro-batch loads into collections, and recommendations on the stored ratings."""
