"""Benchmark decontamination by spaced seeds.

Tokens are the lower-cased runs of letters and digits of a text. A seed is a hash of the tokens
that a fixed mask keeps, so substituted tokens at the other positions do not hide a match.
Benchmark items are indexed at every position, documents are probed at every second one under
both MASKS; around each hit the aligned tokens are compared.

A document is contaminated by an item if WINDOW consecutive tokens of the item stand in it, in
line, with at most SUBSTITUTIONS of them replaced. The two masks hit every such stretch wherever
it begins (tests/llm/test_decontaminate.py tries all), so the search is exact. Items of fewer than
WINDOW tokens must occur whole and unchanged; those of SPAN tokens or fewer, too short for a seed, are
looked up by the hash of the whole item, one pass per length that the benchmark has. A character of a
script without spaces is a token of its own.

Seeds are joined to the documents in blocks of SEEDS rows, each broadcast, so what is broadcast
does not grow with the benchmark and the documents are never shuffled; copies of one passage,
however many, only make more local matches, and per (document, item) one row is kept.

Defined results: null or empty texts match nothing; repeated documents or doc_ids give one row
per doc_id and item; repeated items are items of their own; empty tables give no rows. Other
columns may have any names.
"""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import sheltered, staged

UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
MASKS = ((0, 1, 2, 6, 7), (0, 1, 3, 6, 7))    # token positions that a seed keeps
SPAN = 8
STEP = 2                 # documents are probed at every STEP-th position
WINDOW = 13
SUBSTITUTIONS = 2
SEEDS = 200_000          # seed rows broadcast at a time
AROUND = WINDOW - SPAN   # tokens before a seed that a window around it can reach


def tokens(text: Column) -> Column:
    """Hashes of a text's tokens in order."""
    low = F.lower(text)
    alone = rf"(?![\x00-ɏ])[{UNSPACED}]"      # most characters are ruled out by the cheap test
    apart = F.when(low.rlike(alone), F.regexp_replace(low, f"({alone})", " $1 ")).otherwise(low)
    words = F.array_remove(F.split(apart, r"[^\p{L}\p{N}]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _seed(h: Column, i: Column, number: int) -> Column:
    return F.xxhash64(F.lit(number), *[F.get(h, i + p) for p in MASKS[number]])


def _probe(h: Column, number: int, i: Column) -> Column:
    return _seed(h, i, number)


def _places(h: Column, step: int) -> Column:
    last = F.size(h) - SPAN
    return F.when(last >= 0, F.sequence(F.lit(0), last, F.lit(step))).otherwise(F.array().cast("array<int>"))


def seeds(benchmark: DataFrame) -> DataFrame:
    """One row per item position and mask: seed, item_id, and the item's tokens that a window
    around the seed can hold (null beyond its ends), with the window length to look for."""
    items = (benchmark.select("item_id", tokens(F.col("text")).alias("h"))
             .withColumn("n", F.size("h")).filter(F.col("n") > SPAN)
             .withColumn("at", F.explode(_places(F.col("h"), 1))))
    reach = F.transform(F.sequence(F.col("at") - AROUND, F.col("at") + (WINDOW - 1)),
                        lambda j: F.when(j >= 0, F.get("h", F.greatest(j, F.lit(0)))))
    rows = [items.select(_seed(F.col("h"), F.col("at"), m).alias("seed"), "item_id",
                         F.least("n", F.lit(WINDOW)).alias("need"),
                         F.when(F.col("n") < WINDOW, F.col("at")).alias("whole_at"),
                         F.when(F.col("n") < WINDOW, F.col("h")).otherwise(reach).alias("reach"))
            for m in range(len(MASKS))]
    return reduce(DataFrame.union, rows).distinct()


def _short(documents: DataFrame, benchmark: DataFrame, *keys: str) -> list[DataFrame]:
    """Matches of the items of 1 to SPAN tokens: per length, every run of so many tokens of a document
    is looked up among the items, which are broadcast in blocks of SEEDS rows."""
    items = staged(benchmark.select("item_id", tokens(F.col("text")).alias("item"))
                   .withColumn("n", F.size("item")).filter(F.col("n").between(1, SPAN))
                   .select("item_id", "item", "n", F.xxhash64("item").alias("run")), "short")
    found = []
    for n, many in items.groupBy("n").count().collect():       # SPAN rows at most
        last = F.size("_h") - n
        runs = F.transform(F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>")),
                           lambda i: F.xxhash64(F.slice("_h", i + 1, F.lit(n))))  # noqa: B023
        probed = documents.select(*keys, tokens(F.col("text")).alias("_h")).select(
            *keys, "_h", F.posexplode_outer(runs).alias("_p", "run"))
        blocks = -(-many // SEEDS)
        for b in range(blocks):
            part = items.filter((F.col("n") == n) & (F.pmod(F.xxhash64("run", "item_id"), F.lit(blocks)) == b)).drop("n")
            hits = probed.join(F.broadcast(part), "run").filter(F.slice("_h", F.col("_p") + 1, F.lit(n)) == F.col("item"))
            found.append(hits.groupBy(*keys, "item_id").agg(F.min("_p").cast("long").alias("position"))
                         .select(*keys, "item_id", F.lit(n).alias("matched"), "position"))
    return found


def _alike(near: Column, missing: Column, token: Column, j: Column) -> Column:
    """1 if the item's token stands in the document, 0 if another does; a place beyond either
    end rules out its windows."""
    there = F.get(near, j - missing)
    return F.when(token.isNull() | there.isNull(), -WINDOW).when(token == there, 1).otherwise(0)


def contaminated(documents: DataFrame, benchmark: DataFrame, *keys: str) -> DataFrame:
    """(keys, item_id, matched, position): per document and item, the most equal tokens in one
    window and the first token position at which such a window begins."""
    keys = keys or ("doc_id",)
    index = staged(seeds(benchmark), "seeds")
    blocks = max(1, -(-index.count() // SEEDS))
    h = F.col("_h")
    probed = (documents.select(*keys, tokens(F.col("text")).alias("_h"))
              .withColumn("_places", _places(h, STEP)))
    hashes = [F.transform("_places", partial(_probe, h, m)) for m in range(len(MASKS))]
    # outer: the filter that Spark infers for an inner generator would tokenize again per position
    probed = (probed.select(*keys, "_h", F.size("_places").alias("_n"), F.concat(*hashes).alias("_seeds"))
              .select(*keys, "_h", "_n", F.posexplode_outer("_seeds").alias("_p", "seed")))
    found = _short(documents, benchmark, *keys)
    for b in range(blocks):
        part = index.filter(F.pmod(F.xxhash64("seed", "item_id"), F.lit(blocks)) == b)
        # where the first compared token of the item stands in the document
        start = STEP * F.pmod(F.col("_p"), F.col("_n")) - F.coalesce("whole_at", F.lit(AROUND))
        # a slice of the document travels with the hit, never its whole token array
        there = F.slice("_h", F.greatest(start, F.lit(0)) + 1,
                        F.greatest(F.size("reach") + F.least(start, F.lit(0)), F.lit(0)))
        # the hits are written: their comparison is planned on its own
        hits = staged(probed.join(F.broadcast(part), "seed").select(
            *keys, "item_id", "need", start.alias("_start"), "reach", there.alias("_there")), "hits")
        missing = F.greatest(-F.col("_start"), F.lit(0))
        same = hits.select(*keys, "item_id", "need", "_start", F.transform(
            "reach", partial(_alike, F.col("_there"), missing)).alias("_same"))
        windows = F.transform(F.sequence(F.lit(0), F.size("_same") - F.col("need")), lambda k: F.struct(
            F.aggregate(F.slice("_same", k + 1, F.col("need")), F.lit(0), lambda a, x: a + x).alias("m"), (-k).alias("k")))
        best = same.select(*keys, "item_id", "need", "_start", F.array_max(windows).alias("_best"))
        enough = F.col("_best.m") >= F.when(F.col("need") < WINDOW, F.col("need")).otherwise(WINDOW - SUBSTITUTIONS)
        found.append(best.select(*keys, "item_id", F.when(enough, F.col("_best.m")).alias("matched"),
                                 (F.col("_start") - F.col("_best.k")).cast("long").alias("position")))
    whole = reduce(DataFrame.union, found).groupBy(*keys, "item_id").agg(F.max(F.when(
        F.col("matched").isNotNull(), F.struct("matched", (-F.col("position")).alias("p")))).alias("_b"))
    whole = whole.filter("_b is not null")
    return whole.select(*keys, "item_id", F.col("_b.matched").alias("matched"), (-F.col("_b.p")).alias("position"))


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``documents`` without those that any item contaminates."""
    return sheltered(documents, ("doc_id", "text"), lambda rows: _clean(rows, benchmark))


def _clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    marked = documents.withColumn("_text", F.xxhash64("text"))
    bad = staged(contaminated(marked, benchmark, "doc_id", "_text").select("doc_id", "_text").distinct(), "bad")
    gone = bad.select(F.col("doc_id").alias("_d"), F.col("_text").alias("_t"))
    return marked.join(gone, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_text") == F.col("_t")),
                       "left_anti").drop("_text")


def digest(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The query: one row per contaminated document and item."""
    return contaminated(documents.select("doc_id", "text"), benchmark).select(
        "doc_id", "item_id", "matched", "position")
