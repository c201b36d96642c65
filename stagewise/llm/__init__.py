"""Training-data operators (sharding, scoring, deduplication, packing …).

Nothing outside this subpackage imports it; ``queries.py`` lists the
registered queries and ``__spark_entry__`` adds them when it is present."""
