"""Transaction monitoring on Spark: raw files -> bronze -> silver -> gold -> alerts -> reports."""
