"""Operators for large-scale training-data pipelines: packing, sharding, chat formatting,
toxicity, fingerprints, language-model scores, deduplication, decontamination, licences."""
