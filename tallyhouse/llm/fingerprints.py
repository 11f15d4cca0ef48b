"""Document fingerprints by closed syncmers.

A text is lower-cased and cut into pieces of at most PIECE characters, every word from its beginning:
Latin letters and digits, else other letters, marks and digits; a character of a script without
spaces is a piece of its own. A K-mer is K
consecutive pieces, an S-mer S of them. A K-mer is an anchor when the smallest of its S-mer hashes
stands at one of its edges (a closed syncmer): whether it is depends on the K-mer alone, never on
the text around it, so two texts that share a passage share the anchors inside it, whatever their
positions. A fingerprint is the list of (at, anchor): piece position and 64-bit hash of the K-mer.

``likeness`` is the Jaccard index of two fingerprints' anchors; ``aligned`` matches them by position
and finds the shift that most of them agree on. Everything is built-in expressions.

Defined results: null counts as empty text. A text in which no K-mer is an anchor (it then has
fewer than 2K pieces) is fingerprinted by all its S-mers, by its single piece if it has one, and a
text without letters and digits by nothing; two empty fingerprints are alike (1), an empty one and
another are not (0). A very long text gives a longer fingerprint, its memory is its pieces' hashes.
Repeated rows are rows of their own. In ``successors`` (and the query) null doc_ids come last; rows
of one doc_id follow the hash of their text; the only row of a table is its own successor; an empty
table gives no rows. Other columns pass through; an added column replaces one of its name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, share, sheltered, staged

K, S = 6, 2
PIECE = 4
UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
LATIN = "a-z0-9ß-öø-ɏ"      # first in the pattern: a cheap test for most characters
PIECES = rf"[{LATIN}]{{1,{PIECE}}}|(?![\x00-ɏ])(?:[{UNSPACED}]|[\p{{L}}\p{{M}}\p{{N}}&&[^{UNSPACED}]]{{1,{PIECE}}})"
PER_BOUND = 16       # sampled rows for each boundary between the buckets of ``successors``


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def pieces(text: Column) -> Column:
    """Hashes of a text's pieces in order."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(PIECES), F.lit(0))
    return F.transform(found, lambda p: F.xxhash64(p))


def _smers(p: Column) -> Column:
    """Hashes of all S-mers; a single piece is one."""
    pairs = F.transform(p, lambda x, i: F.xxhash64(x, *[F.get(p, i + j) for j in range(1, S)]))
    return F.slice(pairs, 1, F.greatest(F.size(p) - (S - 1), F.least(F.size(p), F.lit(1))))


def _syncmers(h: Column) -> Column:
    last = K - S

    def anchor(x: Column, i: Column) -> Column:
        edge = F.get(h, i + last)
        inner = F.least(*[F.get(h, i + j) for j in range(1, last)])
        whole = F.xxhash64(x, *[F.get(h, i + j) for j in range(S, last + 1, S)])
        return F.when(edge.isNotNull() & (F.least(x, edge) <= inner),
                      F.struct(i.alias("at"), whole.alias("anchor")))

    return F.filter(F.transform(h, anchor), lambda a: a.isNotNull())


def fingerprint(text: Column) -> Column:
    """array<struct<at int, anchor long>> of a text."""
    every = lambda h: F.transform(h, lambda x, i: F.struct(i.alias("at"), x.alias("anchor")))
    chosen = lambda h: let(_syncmers(h), lambda s: F.when(F.size(s) > 0, s).otherwise(every(h)))
    return let(pieces(text), lambda p: let(_smers(p), chosen))


def written(marks: Column) -> Column:
    """A fingerprint as text: ``at:anchor`` with the anchor in hexadecimal, joined by spaces."""
    return F.array_join(F.transform(marks, lambda m: F.concat(m["at"].cast("string"), F.lit(":"), F.hex(m["anchor"]))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of the anchors of two fingerprints, 0 to 1."""
    def of(x: Column, y: Column) -> Column:
        both = F.size(F.array_intersect(x, y))
        return F.coalesce(both / F.nullif(F.size(x) + F.size(y) - both, F.lit(0)), F.lit(1.0))

    return let(F.array_distinct(a["anchor"]), lambda x: let(F.array_distinct(b["anchor"]), lambda y: of(x, y)))


def fingerprinted(documents: DataFrame, text: str = "text", name: str = "marks") -> DataFrame:
    """``documents`` with their fingerprints."""
    return sheltered(documents, (text,), lambda rows: rows.withColumn(name, fingerprint(F.col(text))))


def aligned(pairs: DataFrame, *keys: str) -> DataFrame:
    """(keys, shift, matched, from_at, to_at) per pair with a common anchor: the shift (position in b
    less position in a) that most common anchors agree on (ties: nearest to 0, then the smallest),
    their number, and the first and last position in ``a`` of those anchors. ``pairs`` holds the keys
    (unique) and fingerprints a and b; anchors that a text repeats match all their occurrences."""
    side = lambda c: pairs.select(*keys, F.explode(c).alias("m")).select(
        *keys, F.col("m.anchor").alias("anchor"), F.col("m.at").alias(f"{c}_at"))
    met = side("a").join(side("b"), [*keys, "anchor"])
    shift = (F.col("b_at") - F.col("a_at")).alias("shift")
    votes = met.groupBy(*keys, shift).agg(F.countDistinct("a_at").alias("matched"), F.min("a_at").alias("from_at"),
                                          F.max("a_at").alias("to_at"))
    order = F.struct(F.col("matched").alias("m"), (-F.abs("shift")).alias("n"), (-F.col("shift")).alias("s"))
    best = votes.groupBy(*keys).agg(F.max_by(F.struct("shift", "matched", "from_at", "to_at"), order).alias("b"))
    return best.select(*keys, "b.*")


def successors(rows: DataFrame, key: Column, columns: list[str],
               prepare: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """``rows`` with ``next``: a struct of ``columns`` of the row that follows in the order of ``key``
    (a struct), the first row for the last one. ``prepare`` adds columns once the rows have crossed
    the network, so that these need not cross it.

    Whole rows cross the network once: buckets of neighbouring keys, cut at quantiles of a sample
    (PER_BOUND rows a bucket), are windows of their own; the first row of a bucket also travels to
    the end of the bucket before it. No bucket holds more than its share of the rows unless
    identical keys do.
    """
    spark = rows.sparkSession
    buckets = 4 * partitions(spark)
    keyed = rows.withColumn("_key", key)
    keys = staged(keyed.select("_key"), "keys")
    chosen = keys.filter(share(buckets * PER_BOUND, keys.count(), "_key"))
    ordered = chosen.agg(F.array_sort(F.collect_list("_key")).alias("s"))
    bounds = staged(ordered.select(F.array_distinct(F.filter(
        "s", lambda x, i: F.pmod(i, F.lit(PER_BOUND)) == PER_BOUND - 1)).alias("bounds")), "bounds")

    steps = F.array(*[F.lit(1 << b) for b in range(buckets.bit_length(), -1, -1)])

    def bucketed(df: DataFrame) -> DataFrame:      # how many boundaries lie below the key, by bisection
        number = F.aggregate(steps, F.lit(0), lambda lo, s: F.when(
            F.get("_cuts", lo + s - 1) < F.col("_key"), lo + s).otherwise(lo))
        return df.withColumn("_cuts", bounds.select("bounds").scalar()).withColumn("_bucket", number).drop("_cuts")

    firsts = staged(bucketed(keys).groupBy("_bucket").agg(F.min("_key").alias("_first")), "firsts")
    around = Window.orderBy("_bucket")                      # one row per bucket
    back = F.coalesce(F.lag("_bucket").over(around), F.max("_bucket").over(Window.partitionBy()))
    ghosts = staged(firsts.select("_first", back.alias("_to")), "ghosts")
    placed = (bucketed(keyed)
              .join(F.broadcast(ghosts), F.col("_key").eqNullSafe(F.col("_first")), "left")
              .withColumn("_in", F.when(F.col("_to").isNull(), F.array(F.struct("_bucket", F.lit(False).alias("_ghost"))))
                          .otherwise(F.array(F.struct("_bucket", F.lit(False).alias("_ghost")),
                                             F.struct(F.col("_to").alias("_bucket"), F.lit(True).alias("_ghost")))))
              .drop("_bucket", "_first", "_to").select("*", F.inline("_in")).drop("_in"))
    line = Window.partitionBy("_bucket").orderBy("_ghost", "_key")
    # the exchange that the window needs, placed below ``prepare``
    return (prepare(placed.repartition("_bucket")).withColumn("next", F.lead(F.struct(*columns)).over(line)).filter(~F.col("_ghost"))
            .drop("_bucket", "_ghost", "_key"))


def digest(documents: DataFrame) -> DataFrame:
    """The query: every text's fingerprint, that of its edited text (the last half replaced by the
    beginning of the next document, descending doc_id), and how alike they and the next one's are."""
    base = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # descending doc_id: the complement falls as the id rises
    key = F.struct(F.col("doc_id").isNull().alias("n"), F.bitwise_not("doc_id").alias("d"), F.xxhash64("text").alias("h"))
    chained = successors(base, key, ["text", "marks"],
                         lambda df: df.withColumn("marks", fingerprint(F.col("text"))))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left(F.col("text"), n - half), F.left(F.col("next.text"), half))
    rows = chained.select("doc_id", n.cast("long").alias("n_chars"), "marks", F.col("next.marks").alias("next_marks"),
                          edited.alias("edited"))
    # one lambda keeps the edited text's fingerprint from being computed for each use
    out = rows.withColumn("out", let(fingerprint(F.col("edited")), lambda e: F.struct(
        written(e).alias("edited_fingerprint"), likeness(F.col("marks"), e).alias("near_edited"))))
    return out.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                      written(F.col("marks")).alias("fingerprint"), "out.edited_fingerprint", "out.near_edited",
                      likeness(F.col("marks"), F.col("next_marks")).alias("near_next"))
