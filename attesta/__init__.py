"""Evidence-record analytics on Spark: landing, linking, reconciling, merging and publishing provenance-first facts."""
