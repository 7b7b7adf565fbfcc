"""Exact deduplication through an extendible-hash index on shared files.

A text's key is the 64-bit hash of its normalised form. The directory is made first, from
the distinct keys: it starts with ``2**start_depth`` buckets, and a bucket that holds more
than ``bucket_keys`` keys is split by one more bit, again and again. Where the bits looked
at so far leave a bucket overfull, the directory doubles eight times more, up to the 64
bits of a key (``max_depth``); a directory of ``n`` bits has a slot for each prefix that
occurs, and slots of one bucket share its depth and number.

Every text is then brought to the bucket that the directory names for its key. Within a
bucket, texts with one key form a chain, and grouping by key *and* text compares their
bytes, so that different texts with equal keys stay apart. Copies are combined before the
shuffle, so a text that makes up a third of all rows sends one row per input partition. The
index has one entry for each distinct text, in files of contiguous ranges of buckets and
keys, each written by one task; rows find their entry through the directory as well. A
directory of at most ``2**20`` slots (16 bytes each) is broadcast, a larger one is joined.

Null text counts as empty. A null id never stays while its group has an id. Repeated
rows (same id and text) count as copies of each other. An empty table gives no rows. Very
long texts are hashed and compared whole. Other columns of the caller may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lockgate.llm.common import SPACE, Work


def normalised(text: Column) -> Column:
    """``text`` with each run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


#: Directories of so many bits are broadcast: a million slots at most.
SMALL = 20


@dataclass(frozen=True)
class Directory:
    """``slots`` holds (slot, depth, bucket): for each prefix of ``bits`` bits, its bucket."""

    slots: DataFrame
    bits: int

    def look_up(self, rows: DataFrame) -> DataFrame:
        """``rows`` with depth and bucket of their ``key``."""
        slots = F.broadcast(self.slots) if self.bits <= SMALL else self.slots
        return rows.withColumn("slot", _prefix(self.bits)).join(slots, "slot").drop("slot")


def _prefix(bits: int) -> Column:
    return F.shiftrightunsigned("key", 64 - bits)


def directory(
    keys: DataFrame, work: Work, bucket_keys: int, start_depth: int, max_depth: int = 64
) -> Directory:
    """The directory of ``keys``, which holds each key once."""
    if not 1 <= start_depth <= max_depth <= 64:
        raise ValueError(f"depths must be 1 to 64 bits: {start_depth}, {max_depth}")
    bits = start_depth
    while True:
        bits = min(bits + 8, max_depth)
        held = keys.groupBy(_prefix(bits).alias("slot")).agg(F.count("*").alias("held"))
        held = work.write(held, f"slots-{bits}")
        if bits == max_depth or (held.agg(F.max("held")).first()[0] or 0) <= bucket_keys:
            break
    depths = F.explode(F.sequence(F.lit(start_depth), F.lit(bits))).alias("depth")
    levels = held.select("slot", "held", depths).withColumn(
        "bucket", F.expr(f"shiftrightunsigned(slot, {bits} - depth)")
    )
    sizes = levels.groupBy("depth", "bucket").agg(F.sum("held").alias("size"))
    fits = (F.col("size") <= bucket_keys) | (F.col("depth") == bits)
    slots = (
        levels.join(sizes, ["depth", "bucket"])
        .filter(fits)
        .groupBy("slot")
        .agg(F.min(F.struct("depth", "bucket")).alias("leaf"))
        .select("slot", "leaf.depth", "leaf.bucket")
    )
    return Directory(work.write(slots, "directory"), bits)


def chained(texts: DataFrame, found: Directory) -> DataFrame:
    """(depth, bucket, key, sha, keep_id, group_size): the chains of all buckets.

    ``texts`` holds (id, key, norm). The directory decides where a text goes; only within
    its bucket is it compared with others.
    """
    return (
        found.look_up(texts)
        .groupBy("depth", "bucket", "key", "norm")
        .agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size"))
        .select("depth", "bucket", "key", F.sha2("norm", 256).alias("sha"), "keep_id", "group_size")
    )


def dedup_index(
    docs: DataFrame,
    work: Work,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_keys: int = 100_000,
    start_depth: int = 4,
    max_depth: int = 64,
) -> tuple[DataFrame, Directory]:
    """Build and write the index: depth, bucket, key, sha, keep_id, group_size per text."""
    texts = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("norm"))
    texts = texts.select("id", F.xxhash64("norm").alias("key"), "norm")
    keys = work.write(texts.select("key").distinct(), "keys")
    found = directory(keys, work, bucket_keys, start_depth, max_depth)
    order = ("depth", "bucket", "key")
    chains = work.write(chained(texts, found), "chains")
    index = chains.repartitionByRange(*order).sortWithinPartitions(*order, "sha")
    index = work.write(index, "index")
    work.drop("chains")
    work.drop("keys")
    return index, found


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **index_args
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    ``kept`` is true for the row that stays; of rows that share the smallest id as well
    as the text, all are marked, because nothing tells them apart.
    """
    work = Work(docs.sparkSession, "exact-dedup")
    index, found = dedup_index(docs, work, id_col, text_col, **index_args)
    norm = normalised(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), norm.alias("norm")).select(
        "doc_id", F.xxhash64("norm").alias("key"), F.sha2("norm", 256).alias("text_sha256")
    )
    entries = index.withColumnRenamed("sha", "text_sha256")
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    place = ["depth", "bucket", "key", "text_sha256"]
    return found.look_up(rows).join(entries, place).select(
        "doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256"
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without copies: of equal texts, one row with the smallest id stays.

    Rows are told by id *and* text, so an id with several texts keeps those that stay. Of
    rows that repeat both, any one stays.
    """
    index, found = dedup_index(docs, Work(docs.sparkSession, "drop-copies"), id_col, text_col)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = docs.select(row, normalised(F.col(text_col)).alias("norm")).select(
        "row", F.xxhash64("norm").alias("key"), F.sha2("norm", 256).alias("sha")
    )
    stays = found.look_up(rows).join(index.drop("group_size"), ["depth", "bucket", "key", "sha"])
    stays = stays.filter(F.col("row")[id_col].eqNullSafe(F.col("keep_id")))
    return stays.dropDuplicates(["key", "sha"]).select("row.*")
