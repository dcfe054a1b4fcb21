"""Operators of a training-data pipeline: packing, near-duplicates, mixing, token files, shards,
top-k search, repeated passages, URL lists, line rules, n-gram scoring, spelling variants, source audits
and byte-pair encoding."""
