"""Case-record analytics on Spark: cleaning, sampling, features, baselines and their evaluation."""
