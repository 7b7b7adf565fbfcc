"""Mixing sources to target weights: Efraimidis-Spirakis sampling without Python.

Every document gets the exponential key ``-ln(u) / w``: ``u`` comes from a hash of its id
and the seed, ``w`` is its quality weight, and smaller keys come first. A source whose
target is ``e`` whole epochs and a rest takes each document ``e`` times; the rest takes
documents in the order of their keys until the budget is spent. The document at the edge
gives only the words that the budget still holds, so a source meets its target to the
word. Sums along a source are prefix sums over ranges of (source, key), so a source that
holds a third of all rows is spread over many tasks.

Null text has size 0. A null source is a source of its own and comes last. Ties in the
key are ordered by id and size; repeated rows are separate documents. An empty table gives
no rows; a source without words has target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lockgate.llm.common import WORD, Work

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
EPOCHS = 2.0


def quality_weight(text: Column) -> Column:
    """0.05 to 1: the share of a text's characters that are letters, squared."""
    text = F.coalesce(text, F.lit(""))
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    share = letters / F.greatest(F.length(text), F.lit(1))
    return F.greatest(F.lit(0.05), share * share)


def targets(sizes: DataFrame, share: float = SHARE, epochs: float = EPOCHS) -> DataFrame:
    """Add ``target`` to (source, source_size): shares by weight, none above ``epochs`` sizes.

    Resharing what capped sources leave, until none is above its cap, ends where a common
    level times the weight meets the caps. Sources are capped in the order of cap / weight,
    so the level follows from running sums; there is one row for each source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.element_at(
        F.array(*map(F.lit, WEIGHTS)), ((F.row_number().over(order) - 1) % len(WEIGHTS) + 1)
    )
    every = Window.partitionBy(F.lit(0))
    ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0.0)
    return (
        sizes.withColumn("weight", cycle)
        .withColumn("cap", F.col("source_size") * F.lit(epochs))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(every) * F.lit(share))
        .withColumn("open", F.sum("weight").over(every))
        .withColumn("full", F.coalesce(F.sum("cap").over(before), zero))
        .withColumn("gone", F.coalesce(F.sum("weight").over(before), zero))
        .withColumn("level", (F.col("total") - F.col("full")) / (F.col("open") - F.col("gone")))
        .withColumn("at", F.row_number().over(ratio))
        .withColumn("first", F.when(F.col("level") <= F.col("ratio"), F.struct("at", "level")))
        .withColumn("level", F.min("first").over(every)["level"])
        .withColumn("target", F.least(F.col("cap"), F.coalesce("level", "ratio") * F.col("weight")))
        .select("source", "source_size", "target")
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = 17,
    weight: Column | None = None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies, part, and the columns in ``carry``.

    ``copies`` are whole takes of the document, ``part`` the words of a partial one;
    ``taken`` = ``copies`` * size + ``part``. ``weight`` replaces the quality weight.
    """
    work = Work(docs.sparkSession, "mix")
    text = F.coalesce(F.col(text_col), F.lit(""))
    weight = quality_weight(F.col(text_col)) if weight is None else weight
    unit = (F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.lit(seed)), 11) + 0.5) / float(2**53)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        (-F.log(unit) / weight).alias("key"),
        *carry,
    )
    order = [F.col("source").asc_nulls_last(), "key", "doc_id", "size"]
    ranged = rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id())
    ranged = work.write(ranged, "ranges")  # sampled ranges have to stay as they are
    part = ranged.groupBy("range", "source").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    part = part.withColumn("ahead", F.coalesce(F.sum("words").over(ahead), F.lit(0)))
    sizes = targets(part.groupBy("source").agg(F.sum("words").alias("source_size")))
    plan = part.select("range", F.col("source").alias("s"), "ahead").join(
        sizes.select(F.col("source").alias("t"), "source_size", "target"),
        F.col("s").eqNullSafe(F.col("t")),
    )
    inside = (
        Window.partitionBy("range", "source")
        .orderBy("key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = ranged.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).alias("r")
    same = (F.col("r.range") == F.col("p.range")) & F.col("source").eqNullSafe(F.col("s"))
    whole = F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))
    left = F.round("target").cast("long") - whole * F.col("source_size")
    part_words = F.greatest(F.lit(0), F.least("size", left - F.col("ahead") - F.col("inside")))
    # a take of the whole text counts as one more copy
    full = (part_words == F.col("size")) & (F.col("size") > 0)
    return (
        placed.join(plan.alias("p"), same)
        .select(
            "doc_id",
            "size",
            "source_size",
            "target",
            (whole * F.col("size") + part_words).cast("long").alias("taken"),
            (whole + F.when(full, 1).otherwise(0)).cast("long").alias("copies"),
            F.when(full, 0).otherwise(part_words).cast("long").alias("part"),
            *carry,
        )
    )


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """The rows of the mix with the columns of ``docs``.

    A document comes once for each whole take. The one at the edge comes once more when
    the budget holds at least half of it: rows stay whole texts.

    Sampling sees ids, sizes and two hashes of the whole row; rows meet their number of
    copies once, at the end. Rows that are equal in every column share their copies, and
    one of them stands for all.
    """
    work = Work(docs.sparkSession, "mixed")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    rows = docs.select(row.alias("row")).select(
        "row", F.xxhash64("row").alias("k1"), F.xxhash64(F.lit(7), F.col("row")).alias("k2")
    )
    narrow = rows.select(
        F.col("row")[id_col].alias("id"),
        F.col("row")[text_col].alias("text"),
        F.col("row")[source_col].alias("source"),
        "k1",
        "k2",
    )
    taken = mix(narrow, "id", "text", "source", carry=("k1", "k2"))
    edge = F.when(F.col("part") * 2 >= F.greatest("size", F.lit(1)), 1).otherwise(0)
    times = taken.groupBy("k1", "k2").agg(
        F.sum(F.col("copies") + edge).cast("int").alias("times"), F.count("*").alias("equal")
    )
    times = work.write(times.filter("times > 0"), "times")
    once, repeated = times.filter("equal = 1"), times.filter("equal > 1")
    found = rows.join(once, ["k1", "k2"]).select("row", "times")
    if not repeated.isEmpty():
        some = rows.join(repeated, ["k1", "k2"]).dropDuplicates(["k1", "k2"])
        found = found.unionByName(some.select("row", "times"))
    return found.select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")
