"""Spark ML jobs: features, splits, classifiers, recommenders, clusters and their metrics."""
