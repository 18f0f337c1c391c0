"""Education warehouse on Spark: raw feeds -> detail tables -> windowed summaries."""
