"""Inspection analytics on Spark: rules, verdicts, frames, boxes, splits, retrieval, streams."""
