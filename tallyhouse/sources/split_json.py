"""JSON list documents of any size, split: elements are found by byte blocks and parsed in parallel.

The text is cut at every closing brace. Whether a piece begins inside a string is the parity of the
quotes before it (escaped characters removed), how deep it lies is the number of brackets open outside
strings; both are prefix sums over the pieces of a block and over the blocks. A block's own sums are
taken for either case (it begins inside a string or not), so that each piece crosses the network once
for them. A closing brace that leaves nothing open but the list ends an element; the pieces since the
element before are put together and parsed as a list of their own, so scalars and nested lists
between objects are elements as well.

The run fails where the top level is no list, an element does not parse, a comma is missing or
superfluous, or the document ends early. The largest element must fit into a task, not the document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyhouse.sources import blocks as B
from tallyhouse.sources.files import population_fields

STRING = r'"[^"]*("|\z)'


def _fail(message: str, kind: str = "string") -> Column:
    return F.raise_error(F.concat(F.lit(f"{message}: "), F.col("file"))).cast(kind)


def _pieces(spark: SparkSession, path) -> tuple[DataFrame, DataFrame]:
    """Pieces with their sums inside the block for both cases, and one row per block."""
    bare = F.regexp_replace("text", r"(?s)\\.", "")
    raw = B.segments(spark, path, "}").withColumn("bare", bare)
    raw = raw.withColumn("odd", (B.occurrences(F.col("bare"), '"') % 2).cast("int"))
    for begins, text in (("out", F.col("bare")), ("in", F.concat(F.lit('"'), F.col("bare")))):
        plain = F.regexp_replace(text, STRING, "")
        opened = sum((B.occurrences(plain, c) for c in "{["), F.lit(0)) - B.occurrences(plain, "]")
        raw = raw.withColumn(f"opened_{begins}", opened)
    raw = raw.drop("bare").withColumn("local", B.before_in_block(F.col("odd")) % 2)
    for case in (0, 1):      # the block begins outside, inside a string
        begins_in = (F.col("local") + case) % 2 == 1
        ends_in = (F.col("local") + case + F.col("odd")) % 2 == 1
        # the closing brace behind the piece counts outside strings
        change = F.when(begins_in, F.col("opened_in")).otherwise(F.col("opened_out")) - F.when(ends_in, 0).otherwise(1)
        raw = raw.withColumn(f"change_{case}", change)
    for case in (0, 1):
        raw = raw.withColumn(f"depth_{case}", B.before_in_block(F.col(f"change_{case}")))
    pieces = B.written(raw.drop("opened_out", "opened_in"), "json-pieces")
    sums = pieces.groupBy("file", "block").agg(
        F.sum("odd").alias("odd"), F.sum("change_0").alias("change_0"), F.sum("change_1").alias("change_1"),
        F.min("seq").alias("first"), F.max("seq").alias("last"))
    sums = sums.withColumn("inside", B.before_block(F.col("odd")) % 2)
    sums = sums.withColumn("change", F.when(F.col("inside") == 1, F.col("change_1")).otherwise(F.col("change_0")))
    whole = Window.partitionBy("file")
    rows = sums.select("file", "block", "inside", B.before_block(F.col("change")).alias("deep"),
                       F.when(F.col("block") == F.min("block").over(whole), F.col("first")).alias("first"),
                       F.when(F.col("block") == F.max("block").over(whole), F.col("last")).alias("last"))
    return pieces, B.written(rows, "json-blocks")


def list_elements(spark: SparkSession, path) -> DataFrame:
    """(item VARIANT, _pos): the elements of the JSON list in every file of ``path``, in order."""
    pieces, rows = _pieces(spark, path)
    case = lambda name: F.when(F.col("inside") == 1, F.col(f"{name}_1")).otherwise(F.col(f"{name}_0"))
    begins_in = (F.col("inside") + F.col("local")) % 2 == 1
    ends_in = (F.col("inside") + F.col("local") + F.col("odd")) % 2 == 1
    depth = F.col("deep") + case("depth")
    first, last = F.coalesce(F.col("seq") == F.col("first"), F.lit(False)), F.coalesce(F.col("seq") == F.col("last"), F.lit(False))
    after = depth + case("change")
    # the last piece has no closing brace: what it leaves open is one more than counted
    left_open = last & (ends_in | (after != -1) | ~F.col("text").rlike(r"\][ \t\r\n]*\z"))
    no_list = first & ~F.col("text").rlike(r"\A[ \t\r\n]*\[")
    early = ~last & ~ends_in & (after < 1)
    text = (F.when(no_list, _fail("population payload is not a list"))
            .when(early | left_open, _fail("population payload ends early or goes on behind its list"))
            .otherwise(F.when(last, F.regexp_replace("text", r"\][ \t\r\n]*\z", "")).otherwise(
                F.concat("text", F.lit("}")))))
    state = pieces.join(rows, ["file", "block"]).select(
        *B.PLACE, text.alias("text"), last.alias("last"), (first | (~begins_in & (depth == 1))).cast("int").alias("starts"),
        (last | (~ends_in & (after == 1))).alias("ends"))
    state = B.written(state, "json-state")
    single = (F.col("starts") == 1) & F.col("ends")
    groups = state.filter(single).select(*B.PLACE, "text").unionByName(B.stitched(state.filter(~single), ""))
    heads = rows.filter("first is not null").select("file", "block", F.col("first").alias("seq"), F.lit(True).alias("head"))
    groups = groups.join(heads, B.PLACE, "left")
    lead = F.when(F.col("head"), r"\A[ \t\r\n]*\[").otherwise(r"\A[ \t\r\n]*,")
    body = F.regexp_replace(F.col("text"), lead, F.lit(""))
    empty = body.rlike(r"\A[ \t\r\n]*\z")
    parsed = F.parse_json(F.concat(F.lit("["), body, F.lit("]")))
    begun = F.col("text").rlike(r"\A[ \t\r\n]*,") | F.col("head")
    # what lies behind the last element, before the list ends
    nothing = F.col("text").rlike(r"\A[ \t\r\n]*\z") | (F.col("head") & empty)
    items = (F.when(nothing, F.expr("CAST(array() AS array<variant>)"))
             .when(~F.coalesce(begun, F.lit(False)) | empty, _fail(
                 "population payload has a comma too few or too many", "array<variant>"))
             .otherwise(F.try_variant_get(parsed, "$", "array<variant>")))
    return groups.select(*B.PLACE, F.posexplode(items).alias("item_no", "item")).select(
        "item", F.struct(*B.PLACE, F.col("item_no").cast("bigint").alias("item")).alias("_pos"))


def read_split_json(spark: SparkSession, path) -> DataFrame:
    """Population JSON documents -> code, name, population, _pos, as ``read_population_json`` gives
    them, but a document is read by as many tasks as it has blocks."""
    return population_fields(list_elements(spark, path))
