"""Training-data operators: dedup, tokenizing, quality, packing, PII, language
models, language ID, WARC and fingerprints.  Nothing else in the library
imports this subpackage."""
