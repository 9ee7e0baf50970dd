"""Training-data operators: dedup, filtering, search, packing and mixing of
text corpora. Nothing else in the library imports this subpackage.

One module per operator (``op1_substring`` ... ``op13_source_divergence``), helpers in
``words`` (word and n-gram hashes over Arrow batches), ``tokens`` (memoised
tokenizer) and ``common`` (written stages, prefix sums, components). The
registered queries are in ``queries``.
"""
