"""Fuzzy line deduplication by MinHash over character shingles.

Every line of every document takes part; of each component of similar lines one is kept. Lines
compare lower-cased and without white space at their ends; blank lines are structure and stay.

1. Equal lines collapse to a class (a 128-bit hash, counted with map-side aggregation), so a line
   that fills a third of the table goes on as one row. Texts and rows are looked up by bitmaps of
   hashed keys, of a fixed size: only lines that may be wanted cross the network, and an exact
   join follows. A line without copies and links takes no part in the last joins.
2. MinHash signatures of one line per class: its anchors (ANCHOR words in a row) are hashed; the
   SKETCH smallest distinct hashes are the signature. Short lines, lines with few anchors, with
   long words on average or with long unbroken runs have a signature of all their
   SHINGLE-character shingles, the ones that are compared; lines of LONG to SHORT characters,
   lines of few anchors and unbroken lines have both, so that no rule parts similar lines that
   stand on either side of it. Bands are pairs of neighbours and next neighbours in a signature
   (all pairs of short signatures); a shared pair makes two lines candidates.
3. Of every line in a group of two or more, the size of its shingle set and PARITY words of
   parity bits are made once; a pair whose sizes and words exclude a link is not compared further.
   In a band's group of GROUP lines or fewer all pairs are compared. In larger groups lines are
   compared with a hub of their size band, in up to TURNS turns while these connect lines; links
   make components. Groups that hold several components even then are split by size bands
   (salted), and every pair in different components is compared that the bounds allow. So every
   pair of a group is compared, connected already or excluded by a bound.
4. Comparison is exact: Jaccard similarity of the sets of all SHINGLE-character shingles of both
   lines (as 64-bit hashes), at least LINK percent.
5. Distributed union-find over the links; a round merges only what lies two
   links apart among the components so far, and a last union-find runs over what is left between
   them. The first line by (doc_id, line number) of each component stays.

All of it is DataFrame functions; what crosses the network are hashes, and texts of candidates.
Signatures are high-recall, not exact: measured against brute force in
tests/llm/test_line_dedup.py.

Defined results: lines end at newline characters; null text has no lines, empty text one blank
line; lines shorter than a shingle are one shingle; repeated rows are separate documents whose
lines are equal; null doc_ids come last; an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import components, release, sheltered, staged

SHINGLE = 8
LINK = 80
ANCHOR = 3           # words of an anchor
PIECE = 64           # shingles are cut from pieces of a line that begin at so many characters
UNBROKEN = 40
WIDE = 12            # characters a word, on average, from which a line's words are too few to stand for it
LONG, SHORT = 40, 64     # lines of LONG characters or more are anchored, those under SHORT hashed at every character
FEW = 6                  # so are lines of fewer anchors
SKETCH = 8
SMALL = 6            # signatures of so many hashes or fewer are banded by all their pairs
GROUP = 8            # lines of a group whose pairs are all compared at once
PARITY = 16          # 64-bit words of parity bits per line of the exact round
STEP = 1.26          # size bands: sizes of linked lines differ by 1.25 times at most
SALT = 1000          # lines of a group per salt
TURNS = 4            # turns of comparing the lines of larger groups with a hub per size band, at most
WORTH = 20           # another turn follows one that moved one line in so many
BITMAP = 1 << 26     # bits of a bitmap of keys, 16 MB as 64-bit numbers of 32 bits each


def normal(line: Column) -> Column:
    return F.lower(F.btrim(line, F.lit(" \t\r\f\x0b")))


def _smallest(hashes: Column) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, SKETCH)


def _nothing() -> Column:
    return F.array().cast("array<bigint>")


def _bound(value: Column, use) -> Column:
    """``use`` of a value that a lambda holds: a column that a lambda reads is copied from its row for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def anchored(line: Column, words: Column) -> Column:
    """The smallest hashes of a normal line's anchors (ANCHOR words in a row, fewer at its end),
    sorted; none of a short line's. ``words``: a column of the line split at spaces."""
    at_words = _bound(words, lambda all_: F.transform(all_, lambda w, i: F.xxhash64(
        w, *[F.get(all_, i + k) for k in range(1, ANCHOR)])))
    return _smallest(F.when(F.length(line) >= LONG, at_words).otherwise(_nothing()))


def everywhere(line: Column, words: Column, anchors: Column) -> Column:
    """The smallest hashes of all shingles of a normal line that its ``anchors`` do not stand for, sorted."""
    use = ((F.length(line) < SHORT) | (F.size(anchors) < FEW) | (F.length(line) > WIDE * F.size(words))
           | F.exists(words, lambda w: F.length(w) >= UNBROKEN))
    return _smallest(F.when(use, shingles(line)).otherwise(_nothing()))


def _pair(sketch: Column, gap: int, i: Column) -> Column:
    return F.xxhash64(F.get(sketch, i), F.get(sketch, i + gap))


def bands(sketch: Column) -> Column:
    """Keys of a signature: pairs of neighbours and of next but one, or all pairs of a short one.
    An unshared hash between two shared ones does not part them."""
    n = F.size(sketch)
    first, last = F.sequence(F.lit(0), n - 2), F.sequence(F.lit(1), n - 1)
    near = F.concat(*[F.transform(F.sequence(F.lit(0), n - 1 - gap), partial(_pair, sketch, gap)) for gap in (1, 2)])
    every = F.flatten(F.transform(first, lambda i: F.transform(
        F.filter(last, lambda j: j > i), lambda j: F.xxhash64(F.get(sketch, i), F.get(sketch, j)))))
    return F.when(n < 2, F.transform(sketch, lambda h: F.xxhash64(h))).when(n <= SMALL, every).otherwise(near)


def shingles(line: Column) -> Column:
    """The set of a line's SHINGLE-character shingles, as 64-bit hashes (of eight ASCII
    characters no two have one hash: xxhash64 maps eight bytes one to one)."""
    # cutting at a character counts from the beginning, hence pieces
    ends = PIECE + SHINGLE - 1
    pieces = F.when(F.length(line) <= ends, F.array(line)).otherwise(F.filter(
        F.regexp_extract_all(line, F.lit(rf"(?s)(?=(.{{1,{ends}}})).{{1,{PIECE}}}"), F.lit(1)),
        lambda p: F.length(p) >= SHINGLE))
    cut = F.flatten(F.transform(pieces, lambda p: F.transform(
        F.sequence(F.lit(1), F.length(p) - SHINGLE + 1), lambda i: F.xxhash64(F.substr(p, i, F.lit(SHINGLE))))))
    # a character of an ASCII line is a byte, found without counting
    bytes_ = _bound(line.cast("binary"), lambda b: F.transform(
        F.sequence(F.lit(1), F.octet_length(b) - SHINGLE + 1), lambda i: F.xxhash64(F.substr(b, i, F.lit(SHINGLE)))))
    return F.when(F.length(line) < SHINGLE, F.array(F.xxhash64(line))).when(
        F.octet_length(line) == F.length(line), F.array_distinct(bytes_)).otherwise(F.array_distinct(cut))


def compared(line: Column) -> Column:
    """A line's SHINGLE-character shingles, repeats included, as 64-bit hashes of their UTF-32 form: every
    character has as many bytes, so none are counted to find one. A shorter line is one shingle."""
    wide = F.lit(4 * SHINGLE)
    return _bound(F.encode(line, "UTF-32"), lambda b: F.when(F.octet_length(b) < wide, F.array(F.xxhash64(b))).otherwise(
        F.transform(F.sequence(F.lit(1), F.octet_length(b) - wide + 1, F.lit(4)), lambda i: F.xxhash64(F.substr(b, i, wide)))))


def _lines(documents: DataFrame) -> DataFrame:
    """All lines: _rid (row), doc_id, _pos, line (normal); blank ones left out."""
    rows = documents.select("_rid", "doc_id", F.posexplode(F.split("text", "\n", -1)).alias("_pos", "_raw"))
    return rows.withColumn("line", normal(F.col("_raw"))).filter("line <> ''").drop("_raw")


def linked_lines(documents: DataFrame) -> DataFrame:
    """Of ``documents`` (_rid, doc_id, text), one row per line that is not blank: _rid, doc_id, _pos, _comp (component), _first (whether
    it is the line kept)."""
    lines = _lines(documents).withColumns({
        "_id": F.monotonically_increasing_id(), "_h1": F.xxhash64("line"), "_h2": F.xxhash64(F.lit(7), "line")})
    lines = staged(lines, "lines")
    copies = lines.groupBy("_h1", "_h2").agg(F.min("_id").alias("cid"), F.count("*").alias("many"))
    copies = staged(copies.filter("many > 1").select("_h1", "_h2", "cid"), "copies")
    copied = _bitmap(copies, "_h1")
    # class of every line that may have a copy; a line left out is its own
    classes = staged(_maybe(lines.select("_id", "_h1", "_h2"), "_h1", copied).join(copies, ["_h1", "_h2"], "left")
                     .select("_id", F.coalesce("cid", "_id").alias("cid")), "classes")
    single = _maybe(lines.select("_id", "_h1", "line"), "_h1", copied, False).select(F.col("_id").alias("cid"), "line")
    reps = single.union(_texts(lines, classes.filter("_id = cid").select("cid")))
    reps = reps.withColumn("_words", F.split("line", " "))
    reps = reps.withColumn("_at", anchored(F.col("line"), F.col("_words")))
    reps = reps.withColumn("_all", everywhere(F.col("line"), F.col("_words"), F.col("_at"))).withColumn(
        "_keys", F.concat(bands(F.col("_at")), bands(F.col("_all"))))
    groups = (reps.select("cid", F.explode(F.array_distinct("_keys")).alias("key"))
              .withColumn("many", F.count("*").over(Window.partitionBy("key"))).filter("many > 1"))
    groups = staged(groups, "groups")
    texts = staged(_texts(lines, groups.select("cid").distinct()), "texts")
    facts = staged(_facts(texts), "facts")

    none = documents.sparkSession.range(0).select(F.col("id").alias("cid"), F.col("id").alias("comp"))
    so_far = _SoFar([], none)
    large = groups.filter(F.col("many") > GROUP).withColumn("comp", F.col("cid"))
    near = _within(groups.filter(F.col("many") <= GROUP)).union(_to_hubs(large, facts, 0)).distinct()
    _advance(_bounded(near, facts), so_far, texts)
    large = staged(_mixed(_named(large, so_far.label)), "large")
    # what follows is about these lines alone
    wanted = staged(large.select("cid").distinct(), "wanted")
    kept = [staged(t.join(wanted, "cid", "left_semi"), "kept") for t in (texts, facts)]
    release(groups, texts, facts, wanted)
    texts, facts = kept
    for turn in range(1, TURNS):
        lines_left = large.select("cid").distinct().count()
        if not lines_left:
            break
        _advance(_bounded(_to_hubs(large, facts, turn), facts), so_far, texts)
        left = staged(_mixed(_named(large, so_far.label)), "large")
        release(large)
        large = left
        if WORTH * so_far.moved.count() < lines_left:
            break
    if not large.isEmpty():
        _advance(_crossing(large.join(facts, "cid")), so_far, texts)

    label = staged(_settled(so_far), "label")
    release(texts, facts, large, *so_far.tested, so_far.label, so_far.ends, so_far.moved)
    member = staged(_members(lines, copied, classes, label), "member")
    release(lines, copies, copied, classes, label)
    place = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("_rid").alias("r"),
                     F.col("_pos").alias("p"))
    joint = member.filter("not _alone")
    best = joint.groupBy("_comp").agg(F.min(place).alias("_best"), F.count("*").alias("_size"))
    alone = member.filter("_alone").withColumns({"_best": place, "_size": F.lit(1).cast("long")})
    return joint.join(best, "_comp").unionByName(alone).drop("_alone").withColumn(
        "_first", (F.col("_rid") == F.col("_best.r")) & (F.col("_pos") == F.col("_best.p")))


def _members(lines: DataFrame, copied: DataFrame, classes: DataFrame, label: DataFrame) -> DataFrame:
    """_rid, doc_id, _pos, _comp of every line, and _alone: whether it has neither copies nor links."""
    linked = _bitmap(label, "cid")
    rows = _marked(_marked(lines.select("_rid", "doc_id", "_pos", "_id", "_h1"), "_h1", copied, "_c"), "_id", linked, "_l")
    rows = rows.withColumn("_alone", ~(F.col("_c") | F.col("_l"))).drop("_h1", "_c", "_l")
    joint = (rows.filter("not _alone").join(classes, "_id", "left").withColumn("cid", F.coalesce("cid", "_id"))
             .join(label, "cid", "left").withColumn("_comp", F.coalesce("comp", "cid")))
    out = ["_rid", "doc_id", "_pos", "_comp", "_alone"]
    return joint.select(*out).union(rows.filter("_alone").withColumn("_comp", F.col("_id")).select(*out))


def _place(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BITMAP)) + 1


def _bitmap(rows: DataFrame, key: str) -> DataFrame:
    """A bitmap of hashed keys, of a size that does not grow with them: _bucket, _words (32 bits each, the
    first byte highest). It says of a key that it is surely not among them, or that it may be."""
    bits = rows.select(_place(key).alias("x")).groupBy(F.bitmap_bucket_number("x").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("x")).alias("bits"))
    # numbers, as a row's array is read in place and its bytes are copied
    words = _bound(F.col("bits"), lambda b: F.transform(F.sequence(F.lit(1), F.octet_length(b) - 3, F.lit(4)), lambda i: F.conv(
        F.hex(F.substr(b, i, F.lit(4))), 16, 10).cast("long")))
    return staged(bits.select("_bucket", words.alias("_words")), "bitmap")


def _marked(rows: DataFrame, key: str, bitmap: DataFrame, name: str) -> DataFrame:
    """``rows`` with ``name``: whether the key may be in the bitmap."""
    at = F.bitmap_bit_position(_place(key))
    met = rows.withColumn("_bucket", F.bitmap_bucket_number(_place(key))).join(F.broadcast(bitmap), "_bucket", "left")
    word = F.get(F.col("_words"), F.shiftright(at, 5).cast("int"))
    inside = (24 - 8 * F.pmod(F.shiftright(at, 3), F.lit(4)) + F.pmod(at, F.lit(8))).cast("int")
    bit = F.call_function("shiftright", word, inside).bitwiseAND(F.lit(1))
    return met.withColumn(name, F.coalesce(bit == 1, F.lit(False))).drop("_bucket", "_words")


def _maybe(rows: DataFrame, key: str, bitmap: DataFrame, inside: bool = True) -> DataFrame:
    """Of ``rows`` those whose key may be in the bitmap, or the others."""
    return _marked(rows, key, bitmap, "_in").filter(F.col("_in") == F.lit(inside)).drop("_in")


def _texts(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """cid and line of the ``wanted`` (cid) lines. A bitmap keeps most other texts out of the exchange."""
    wanted = staged(wanted, "wanted")
    rows = lines.select(F.col("_id").alias("cid"), "line")
    return _maybe(rows, "cid", _bitmap(wanted, "cid")).join(wanted, "cid", "left_semi")


def _within(members: DataFrame) -> DataFrame:
    """All pairs (a < b) of the groups of ``members`` (key, cid)."""
    x, y = members.select("key", F.col("cid").alias("a")), members.select("key", F.col("cid").alias("b"))
    return x.join(y, "key").filter("a < b").select("a", "b")


def _pairs(df: DataFrame) -> DataFrame:
    """Pairs (a < b), once each."""
    return df.select(F.least("o", "cid").alias("a"), F.greatest("o", "cid").alias("b")).distinct()


def _named(members: DataFrame, label: DataFrame) -> DataFrame:
    """``members`` (key, cid, many) with the component of each line."""
    return members.select("key", "cid", "many").join(label, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))


def _mixed(now: DataFrame) -> DataFrame:
    """The rows of the groups that hold several components."""
    spread = now.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    return now.join(spread.filter("lo < hi").select("key"), "key", "left_semi")


def _to_hubs(large: DataFrame, facts: DataFrame, turn: int) -> DataFrame:
    """Pairs of each line with one line of its group and size band (by a hash that differs per
    ``turn``) that lies in another component: of near copies of one line most meet at once."""
    banded = large.join(facts.select("cid", "n"), "cid").withColumn("band", F.floor(F.ln("n") / F.ln(F.lit(STEP))))
    hubs = banded.groupBy("key", "band").agg(F.min(F.struct(
        F.xxhash64(F.lit(turn), "cid").alias("h"), F.col("cid").alias("o"), F.col("comp").alias("c"))).alias("hub"))
    met = banded.join(hubs, ["key", "band"]).filter(F.col("hub.c") != F.col("comp"))
    return _pairs(met.select("cid", F.col("hub.o").alias("o")))


@dataclass
class _SoFar:
    """What the rounds know: pairs compared (a, b, linked), one table per round; the component
    each linked line is known to lie in (label: cid, comp); the last round's links between
    components (ends: a, b) and where it moved these (moved: id, component)."""

    tested: list[DataFrame]
    label: DataFrame
    ends: DataFrame | None = None
    moved: DataFrame | None = None


def _advance(pairs: DataFrame, now: _SoFar, texts: DataFrame) -> None:
    """A round over ``pairs`` that the bounds allow: those not compared yet are compared, and every
    component moves to the smallest within two links of it, so that a star of new links becomes
    one. Lines of one label are connected; not all that are connected need have one label yet."""
    if now.tested:
        known = reduce(DataFrame.union, [t.select("a", "b") for t in now.tested])
        pairs = pairs.join(known, ["a", "b"], "left_anti")
    new = staged(_checked(pairs, texts), "checked")
    now.tested.append(new)
    links = new.filter("linked").select("a", "b")
    for side in ("a", "b"):
        links = links.join(now.label.select(F.col("cid").alias(side), F.col("comp").alias("c" + side)), side, "left")
    links = links.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    if now.ends is not None:
        links = links.union(_left_between(now))
    ends = staged(links.filter("a <> b").distinct(), "ends")
    both = ends.union(ends.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("b"), F.least("a", "m").alias("m"))
    moved = staged(both.join(least, "b").groupBy(F.col("a").alias("id")).agg(F.min("m").alias("component")), "moved")
    label = staged(_relabelled(now.label, moved), "label")
    release(now.label, now.ends, now.moved)
    now.label, now.ends, now.moved = label, ends, moved


def _left_between(now: _SoFar) -> DataFrame:
    """The links of the last round that still lie between components (a, b)."""
    left = now.ends
    for side in ("a", "b"):
        left = left.join(now.moved.select(F.col("id").alias(side), F.col("component").alias("c" + side)), side)
    return left.select(F.col("ca").alias("a"), F.col("cb").alias("b")).filter("a <> b")


def _relabelled(label: DataFrame, moved: DataFrame) -> DataFrame:
    """``label`` after components moved; a line that no link had met before is its own component."""
    lines = label.union(moved.select(F.col("id").alias("cid"), F.col("id").alias("comp")).join(
        label.select("cid"), "cid", "left_anti"))
    return lines.join(moved.select(F.col("id").alias("comp"), "component"), "comp", "left").select(
        "cid", F.coalesce("component", "comp").alias("comp"))


def _settled(now: _SoFar) -> DataFrame:
    """(cid, comp) of every linked line, all links counted."""
    last = components(_left_between(now)).select(F.col("id").alias("comp"), "component")
    return now.label.join(last, "comp", "left").select("cid", F.coalesce("component", "comp").alias("comp"))


def _facts(texts: DataFrame) -> DataFrame:
    """Per line the size n of its shingle set and PARITY words of parity bits: every shingle
    flips one bit, so the words of two lines differ in at most as many bits as their sets in
    shingles."""
    hashed = texts.select("cid", F.explode(F.array_distinct(compared(F.col("line")))).alias("h"))
    word = F.pmod("h", F.lit(PARITY))
    bit = F.expr("shiftleft(1L, cast(pmod(shiftright(h, 32), 64) as int))")
    return hashed.groupBy("cid").agg(F.count("*").alias("n"), *[
        F.bit_xor(F.when(word == i, bit).otherwise(F.lit(0).cast("long"))).alias(f"p{i}") for i in range(PARITY)])


def _crossing(full: DataFrame) -> DataFrame:
    """Every pair (a < b) of a group whose members lie in different components and whose sizes
    and parity words allow a link, once: in the first of the groups that hold both. A group is joined
    in parts: by size band, as the larger set of a link lies in the band of the smaller or in the
    next, and by salt."""
    keys = full.groupBy("cid").agg(F.collect_set("key").alias("keys"))
    full = full.join(keys, "cid").withColumns({"band": F.floor(F.ln("n") / F.ln(F.lit(STEP))), "salts": F.ceil(F.col("many") / SALT)})
    x = full.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).withColumn(
        "band", F.explode(F.array(F.col("band"), F.col("band") + 1))).alias("x")
    y = full.withColumn("salt", F.pmod(F.xxhash64("cid"), F.col("salts"))).alias("y")
    c = lambda side, name: F.col(f"{side}.{name}")
    met = (c("x", "key") == c("y", "key")) & (c("x", "band") == c("y", "band")) & (c("x", "salt") == c("y", "salt"))
    n, m = c("x", "n"), c("y", "n")
    order = (n < m) | ((n == m) & (c("x", "cid") < c("y", "cid")))
    first = F.array_min(F.array_intersect(c("x", "keys"), c("y", "keys"))) == c("x", "key")
    pair = x.join(y, met & order & (c("x", "comp") != c("y", "comp")) & _allowed("x", "y") & first)
    return pair.select(F.least("x.cid", "y.cid").alias("a"), F.greatest("x.cid", "y.cid").alias("b"), (n + m).alias("sizes"))


def _allowed(x: str, y: str) -> Column:
    """Whether the sizes and parity words of two lines allow a link."""
    c = lambda side, name: F.col(f"{side}.{name}")
    n, m = c(x, "n"), c(y, "n")
    differ = sum(F.bit_count(c(x, f"p{i}").bitwiseXOR(c(y, f"p{i}"))) for i in range(PARITY))
    # |A & B| = (n + m - d) / 2, so similarity LINK percent bounds the difference d of the sets
    return (100 * F.least(n, m) >= LINK * F.greatest(n, m)) & ((100 + LINK) * differ <= (100 - LINK) * (n + m))


def _bounded(pairs: DataFrame, facts: DataFrame) -> DataFrame:
    """The ``pairs`` whose bounds allow a link, before any text is read, and the sizes of both sets in sum."""
    met = pairs.join(facts.alias("x"), F.col("a") == F.col("x.cid")).join(facts.alias("y"), F.col("b") == F.col("y.cid"))
    return met.filter(_allowed("x", "y")).select("a", "b", (F.col("x.n") + F.col("y.n")).alias("sizes"))


def _checked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, linked) of ``pairs`` (a, b, sizes): whether the shingle sets of both lines are similar enough."""
    sets = (pairs.join(texts.select(F.col("cid").alias("a"), F.col("line").alias("ta")), "a")
            .join(texts.select(F.col("cid").alias("b"), F.col("line").alias("tb")), "b")
            .select("a", "b", "sizes", F.size(F.array_intersect(compared(F.col("ta")), compared(F.col("tb")))).alias("both")))
    return sets.select("a", "b", (100 * F.col("both") >= LINK * (F.col("sizes") - F.col("both"))).alias("linked"))


def dedup_lines(documents: DataFrame) -> DataFrame:
    """``documents`` with every line dropped from ``text`` that is not its component's first; a
    document left without a line has an empty text."""
    return sheltered(documents, ("doc_id", "text"), _dedup_lines)


def _dedup_lines(documents: DataFrame) -> DataFrame:
    rows = staged(documents.withColumn("_rid", F.monotonically_increasing_id()), "line_rows")
    gone = (linked_lines(rows.select("_rid", "doc_id", "text")).filter(~F.col("_first"))
            .groupBy("_rid").agg(F.array_sort(F.collect_list("_pos")).alias("_gone")))
    lines = F.split("text", "\n", -1)
    # line numbers to drop, as gaps: the lines between two of them are one slice
    edges = F.concat(F.array(F.lit(-1)), "_gone", F.array(F.size(lines)))
    kept = F.flatten(F.transform(F.sequence(F.lit(0), F.size("_gone")), lambda i: F.slice(
        "_lines", F.get("_edges", i) + 2, F.get("_edges", i + 1) - F.get("_edges", i) - 1)))
    joined = rows.join(staged(gone, "gone"), "_rid", "left").withColumns({"_lines": lines, "_edges": edges})
    return joined.withColumn("text", F.when(F.col("_gone").isNull(), F.col("text")).otherwise(
        F.array_join(kept, "\n"))).select(*documents.columns)


def digest(documents: DataFrame) -> DataFrame:
    """The query: one row per line that is not blank: doc_id, line_no, kept, keep_doc_id and
    keep_line_no (the line that stays for it), group_size."""
    return linked_lines(documents.select(F.monotonically_increasing_id().alias("_rid"), "doc_id", "text")).select(
        "doc_id", F.col("_pos").alias("line_no"), F.col("_first").alias("kept"),
        F.col("_best.d").alias("keep_doc_id"), F.col("_best.p").alias("keep_line_no"),
        F.col("_size").alias("group_size"))
