"""Operators for preparing training data: classify, deduplicate, decontaminate, mix and shard text."""
