"""Batch feed loading on Spark: repair, stage, resolve, validate, upsert, audit."""
