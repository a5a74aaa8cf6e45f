"""Training-data operators: mixing, packing, fingerprints, secret scans, language
identification, quality rules, WARC archives, substring / near / line deduplication.

Nothing else in the library imports this subpackage; ``__spark_entry__`` adds its
queries when it can be imported.
"""
