"""Operators of a training-data pipeline: search, token counts, packing, language
ID, near-duplicates, language-model scores, tokenizer, fingerprints, license and
toxicity scans.  Nothing outside this subpackage imports it."""
