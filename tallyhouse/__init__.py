"""tallyhouse: a Spark-native warehouse for country-level labour statistics.

Layers (all Parquet, all DataFrame plans):

* raw      -- landed CSV rate feeds and the population JSON feed, text as received
* staging  -- validated, typed, one row per natural key (keep-first / keep-last)
* mart     -- rate fact, Total/15+ slice, population snapshot, slice with population
* audit    -- append-only per-source change log (row count + content fingerprint)

Sub-packages:

* ``sources``    -- CSV / JSON readers, warehouse table layout, feeds derived from test tables
* ``functions``  -- column expressions: validation, derived metrics, fingerprints, constraints
* ``operators``  -- keep-first / keep-last, upserts, distributed ntile, top-k, audit
* ``plans``      -- staging and mart builders, the analytic query catalogue, the full run
* ``streaming``  -- incremental landing of rate files with Structured Streaming
"""

__version__ = "0.1.0"
