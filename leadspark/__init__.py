"""Lead-funnel analytics on Spark: collect, deduplicate, score, queue, report."""
