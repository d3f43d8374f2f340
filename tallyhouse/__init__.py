"""Order analytics on Spark: staging, star schema, change capture and marts as DataFrame functions."""
