"""Record linkage on Spark: blocking, retrieval, pair features, labelling, matching, validation."""
