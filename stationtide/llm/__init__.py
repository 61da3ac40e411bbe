"""Operators for training-data corpora: quality, token counts, decontamination, encoding, sharding, licences,
languages, web archives and near-duplicates. Nothing outside this subpackage imports it."""
