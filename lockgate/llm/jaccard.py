"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of its 5-word shingles. Two documents link when their sets have a
Jaccard similarity of ``percent`` / 100 or more. Shingles are ordered from rare to
frequent, by a count sketch over all documents; documents that link then share a shingle
among their first n - ceil(0.75 n) + 1. The sketch grows with the input up to 64 MB. A prefix that is ``l - 1`` longer has to share
``l``: every document picks its own ``l`` (1 to 5) from the estimated number of candidates
in its prefix, and a pair has to share the smaller of the two. The order and the lengths
only decide how much work there is, never which pairs are found.

Pairs are not made within groups of copies. Each document is first verified against one
leader, the document of smallest id that shares most of its prefix, and then against
documents that share most with all; what links becomes one component. Then all pairs that share enough prefix tokens *and* lie in different
components are verified, after parity bitmaps of the sets, a few bits for each shingle,
have ruled out most: they differ in no more places than the sets do. That loses no link between components, and a group of thousands
of near copies costs as many pairs as it has members.

Families whose members are alike but below the threshold share most of their prefixes. There
each member is put as its difference from a centre, a member that shares most with all. Two
members differ in as many shingles as their differences hold, without those that are in both,
so a pair that links needs differences that overlap by a known number; prefixes of the
differences find such pairs. What a family has in common isn't in them, as far as its
centre has it too; what sets the centre apart is in all of them and costs pairs, not links.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case. Fewer than five words are one
shingle; null and empty texts have none and link with nothing. Rows of equal id are one
document, whose links are those of any of its rows; rows without an id link with nothing.
Shingles are compared as 58-bit hashes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lockgate.llm.common import Work
from lockgate.llm.components import components
from lockgate.llm.rolling import Ranges

CHUNK = 1 << 20
CROWD = 16  # documents of a token from which on they may be a family
SLICES = 64
LOAD = 32  # shingles that a counter of the sketch holds on average
SMALLEST, LARGEST = 14, 26  # bits of the sketch: a broadcast of 16 KB to 64 MB
LOW = np.uint64((1 << 58) - 1)


def shingle_sets(texts: list[bytes], width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(index, distinct 58-bit shingle hashes ascending) of each text that has a word."""
    held: list[tuple[int, bytes]] = []
    size = 0
    for i, text in enumerate(texts):
        norm = b" ".join(text.lower().split())
        if norm:
            held.append((i, norm))
            size += len(norm) + 1
        if size >= CHUNK:
            yield from _sets(held, width)
            held, size = [], 0
    if held:
        yield from _sets(held, width)


def _sets(held: list[tuple[int, bytes]], width: int) -> Iterator[tuple[int, np.ndarray]]:
    data = np.frombuffer(b" ".join(t for _, t in held), np.uint8)
    ranges = Ranges(data)
    gaps = np.flatnonzero(data == 32)
    starts = np.r_[0, gaps + 1]
    ends = np.r_[gaps, len(data)]
    at = 0
    for i, text in held:
        n = text.count(b" ") + 1
        m = max(1, n - width + 1)
        last = at + min(width, n) - 1
        hashes = ranges.hash(starts[at : at + m], ends[last : last + m])
        yield i, np.unique(hashes & LOW)
        at += n


def least_shared(n: int, percent: int) -> int:
    """Shingles that a set of ``n`` shares at least with any set it links with."""
    return -(-percent * n // 100)


def _sketched(rows: DataFrame, width: int, bits: int) -> DataFrame:
    """doc_id and n of each row; rows with a ``slice`` hold counts of the sketch instead."""
    kind = dict(rows.dtypes)["id"]
    low = np.uint64((1 << bits) - 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "n", "slice", "counts"]
        sketch = np.zeros(1 << bits, np.uint32)
        id_type = None
        for batch in batches:
            id_type = batch.column("id").type
            sizes = np.zeros(batch.num_rows, np.int64)
            for i, own in shingle_sets(batch.column("text").to_pylist(), width):
                sizes[i] = len(own)
                np.add.at(sketch, own & low, 1)
            nulls = [pa.nulls(batch.num_rows, pa.int32()), pa.nulls(batch.num_rows, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes), *nulls], names)
        if id_type is not None:
            parts = [zlib.compress(p.tobytes(), 1) for p in np.split(sketch, SLICES)]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(SLICES, id_type), pa.nulls(SLICES, pa.int64()),
                 pa.array(range(SLICES), pa.int32()), pa.array(parts, pa.binary())], names)

    return rows.mapInArrow(count, f"id {kind}, n long, slice int, counts binary")


def _classes(sketched: DataFrame, bits: int) -> np.ndarray:
    """For each counter the power of two of how far it is above the average."""

    def add(rows: pa.Table) -> pa.Table:
        total = np.zeros((1 << bits) // SLICES)
        for blob in rows.column("counts"):
            total += np.frombuffer(zlib.decompress(blob.as_py()), np.uint32)
        # what a counter holds on average says nothing about its heaviest shingle
        over = total - total.mean() - 4 * total.mean() ** 0.5
        found = np.log2(np.maximum(over, 1)).astype(np.uint8)
        blob = pa.array([zlib.compress(found.tobytes(), 1)], pa.binary())
        return pa.table({"slice": rows.column("slice")[:1], "classes": blob})

    slices = sketched.filter("slice is not null").select("slice", "counts")
    classes = np.zeros((SLICES, (1 << bits) // SLICES), np.uint8)
    for r in slices.groupBy("slice").applyInArrow(add, "slice int, classes binary").collect():
        classes[r.slice] = np.frombuffer(zlib.decompress(r.classes), np.uint8)
    return classes.ravel()


def _by_rarity(own: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Shingles as tokens, from rare to frequent."""
    rank = classes[own & np.uint64(len(classes) - 1)].astype(np.uint64)
    return np.sort((rank << np.uint64(58)) | own)


def _prefixes(rows: DataFrame, shared, width: int, percent: int) -> DataFrame:
    """(token, id, meta) of each document's prefix; meta is n * 8 + the matches asked for."""
    kind = dict(rows.dtypes)["id"]
    guess = 2.0 ** np.arange(64)

    def prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = shared.value
        for batch in batches:
            tokens, places, metas = [], [], []
            for i, own in shingle_sets(batch.column("text").to_pylist(), width):
                own = _by_rarity(own, classes)
                n = len(own)
                base = n - least_shared(n, percent) + 1
                cost = guess[(own[:base] >> np.uint64(58)).astype(np.int64)].mean()
                matches = 1 if cost < 16 else 2 if cost < 64 else 3 if cost < 256 else 4 if cost < 1024 else 5
                matches = min(matches, n - base + 1)
                tokens.append(own[: base + matches - 1])
                places.append(np.full(len(tokens[-1]), i))
                metas.append(np.full(len(tokens[-1]), n * 8 + matches))
            if not tokens:
                continue
            at, token, meta = map(np.concatenate, (places, tokens, metas))
            ids = batch.column("id").take(pa.array(at))
            for a in range(0, len(at), 100_000):
                cut = slice(a, a + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(token[cut].view(np.int64)), ids[a : a + 100_000], pa.array(meta[cut])],
                    ["token", "id", "meta"],
                )

    return rows.mapInArrow(prefix, f"token long, id {kind}, meta long")


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by token and id, those whose token occurs again, with the first of it."""
    kept: pa.RecordBatch | None = None  # the last row, which may still be alone
    again = False  # whether its token came before
    lead: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if kept is None else pa.Table.from_batches([kept, batch]).combine_chunks().to_batches()[0]
        token = rows.column("token").to_numpy()
        n = len(token)
        same = np.r_[again, token[1:] == token[:-1]]
        take = same.copy()
        take[:-1] |= same[1:]
        first = np.maximum.accumulate(np.where(same, 0, np.arange(n)))
        heads = rows.take(pa.array(first))
        leader, leader_meta = heads.column("id"), heads.column("meta")
        if again and lead is not None:  # the run at the front began in an earlier batch
            run = n if same.all() else int(np.argmin(same))
            leader = pa.concat_arrays([pa.array([lead[0]] * run, leader.type), leader[run:]])
            leader_meta = pa.concat_arrays([pa.array([lead[1]] * run, leader_meta.type), leader_meta[run:]])
        out = pa.RecordBatch.from_arrays(
            [*rows.columns, leader, leader_meta], ["token", "id", "meta", "leader", "leader_meta"]
        )
        take[-1] = False
        yield out.filter(pa.array(take))
        kept, again = rows.slice(n - 1), bool(same[-1])
        lead = (leader[n - 1].as_py(), leader_meta[n - 1].as_py())
    if kept is not None and again:
        yield pa.RecordBatch.from_arrays(
            [*kept.columns, pa.array([lead[0]], kept.column("id").type), pa.array([lead[1]], pa.int64())],
            ["token", "id", "meta", "leader", "leader_meta"],
        )


def _plausible(a: str, b: str, percent: int):
    """Sizes and shared prefix tokens of a pair that may link."""
    small, large = F.least(F.shiftright(a, 3), F.shiftright(b, 3)), F.greatest(F.shiftright(a, 3), F.shiftright(b, 3))
    asked = F.least(F.col(a).bitwiseAND(7), F.col(b).bitwiseAND(7))
    return (100 * small >= percent * large) & (F.col("shared") >= asked)


def _verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets meet the threshold."""
    kind = dict(pairs.dtypes)["a"]

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = dict(shingle_sets(batch.column("text_a").to_pylist(), width))
            right = dict(shingle_sets(batch.column("text_b").to_pylist(), width))
            good = np.zeros(batch.num_rows, bool)
            for i, x in left.items():
                y = right.get(i)
                if y is not None:
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    good[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    held = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    held = held.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    return held.select("a", "b", "text_a", "text_b").mapInArrow(check, f"a {kind}, b {kind}")


def _parities(texts: DataFrame, shared, width: int) -> DataFrame:
    """(id, n, bits, fame): a bitmap of 4 to 8 places a shingle, each the parity of its shingles.

    ``fame`` is how frequent the shingles are in all documents, on average.
    """
    kind = dict(texts.dtypes)["id"]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = shared.value
        low = np.uint64(len(classes) - 1)
        for batch in batches:
            sizes, bits = [0] * batch.num_rows, [b""] * batch.num_rows
            fame = np.zeros(batch.num_rows)
            for i, own in shingle_sets(batch.column("text").to_pylist(), width):
                places = 1 << max(6, (4 * len(own) - 1).bit_length())
                at = (own & np.uint64(places - 1)).astype(np.int64)
                bits[i] = np.packbits((np.bincount(at, minlength=places) & 1).astype(np.uint8)).tobytes()
                sizes[i] = len(own)
                fame[i] = np.exp2(classes[own & low], dtype=float).mean()
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(bits, pa.binary()), pa.array(fame)],
                ["id", "n", "bits", "fame"],
            )

    return texts.mapInArrow(fold, f"id {kind}, n long, bits binary, fame double")


def difference_at_least(a: bytes, b: bytes) -> int:
    """A lower bound for the symmetric difference of the sets behind two parity bitmaps."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _possible(pairs: DataFrame, parities: DataFrame, percent: int) -> DataFrame:
    """``pairs`` without those whose bitmaps differ too much to link."""
    kind = dict(pairs.dtypes)["a"]

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            bits = zip(batch.column("bits_a").to_pylist(), batch.column("bits_b").to_pylist(), strict=True)
            apart = np.array([difference_at_least(x, y) for x, y in bits], np.int64)
            # of sets with similarity s the difference is (1 - s) / (1 + s) of both sizes
            good = apart * (100 + percent) <= total * (100 - percent)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    held = pairs.join(parities.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a")), "a")
    held = held.join(parities.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b")), "b")
    return held.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(check, f"a {kind}, b {kind}")


def _open(rows: DataFrame, comps: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """(token, id, meta, comp) of the tokens that occur in several components.

    With ``members``, also each document's ``centre``; tokens that only one family has go.
    """
    placed = rows.join(comps, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    token = Window.partitionBy("token")
    placed = placed.withColumn("low", F.min("comp").over(token)).withColumn("high", F.max("comp").over(token))
    if members is None:
        return placed.filter("low <> high").select("token", "id", "meta", "comp")
    placed = placed.join(members.select("id", "centre"), "id", "left")
    placed = (
        placed.withColumn("least", F.min("centre").over(token))
        .withColumn("most", F.max("centre").over(token))
        .withColumn("alone", F.count_if(F.col("centre").isNull()).over(token))
    )
    several = F.col("least").isNull() | (F.col("least") != F.col("most")) | (F.col("alone") > 0)
    return placed.filter((F.col("low") != F.col("high")) & several).select("token", "id", "meta", "comp", "centre")


def _popular(rows: DataFrame, percent: int) -> DataFrame:
    """For each document a leader (a, b) in another component: of the documents that
    share most tokens with all others, the one that it shares most with."""
    token = Window.partitionBy("token")
    fame = rows.withColumn("df", F.count("*").over(token)).groupBy("id").agg(F.sum("df").alias("fame"))
    first = F.first(F.struct("id", "meta", "comp")).over(token.orderBy(F.col("fame").desc(), "id"))
    votes = (
        rows.join(fame, "id")
        .withColumn("lead", first)
        .filter("comp <> lead.comp")
        .groupBy("id", "meta", F.col("lead.id").alias("leader"), F.col("lead.meta").alias("leader_meta"))
        .agg(F.count("*").alias("shared"))
        .filter(_plausible("meta", "leader_meta", percent))
    )
    best = votes.groupBy("id").agg(F.max(F.struct("shared", "leader")).alias("best"))
    return best.select(F.col("id").alias("a"), F.col("best.leader").alias("b"))


def _centres(rows: DataFrame, parities: DataFrame) -> DataFrame:
    """(a, b): documents with crowded tokens, and the one that has most of these of a.

    The leader of a token is, of its documents, the one with the most frequent shingles: what
    sets a member of a family apart is rare.
    """
    token = Window.partitionBy("token")
    crowded = rows.withColumn("df", F.count("*").over(token)).filter(F.col("df") >= CROWD)
    fame = parities.groupBy("id").agg(F.max("fame").alias("fame"))
    leader = F.first("id").over(token.orderBy(F.col("fame").desc(), "id"))
    votes = crowded.join(fame, "id").withColumn("leader", leader).groupBy("id", "leader").agg(F.count("*").alias("shared"))
    best = votes.groupBy("id").agg(F.max(F.struct("shared", "leader")).alias("best"))
    return best.select(F.col("id").alias("a"), F.col("best.leader").alias("b"))


def _deltas(pairs: DataFrame, texts: DataFrame, shared, width: int, percent: int) -> DataFrame:
    """(id, centre, token, excess, rest): the prefix of each a's difference from its b.

    Sets x and y of sizes n and m link when they differ in at most (n + m) * (100 - percent) /
    (100 + percent) shingles. They differ in dx + dy - 2 * common, where dx and dy are their
    differences from the centre. With ``excess`` dx * (100 + percent) - n * (100 - percent) that
    is: 2 * (100 + percent) * common >= excess of x + excess of y. ``rest`` is the left side if all
    from this token on were common, so the first common token of a pair that links has
    a rest on both sides that is large enough.

    A row without token says that the document has the centre; its rest is the largest excess
    with which a document links with the centre itself. Documents that are not much like
    their centre get no rows.
    """
    kind = dict(pairs.dtypes)["a"]
    plus, minus = 100 + percent, 100 - percent

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = shared.value
        for batch in batches:
            left = dict(shingle_sets(batch.column("text_a").to_pylist(), width))
            right = dict(shingle_sets(batch.column("text_b").to_pylist(), width))
            places, tokens, excesses, rests = [], [], [], []
            for i, x in left.items():
                centre = right.get(i)
                if centre is None:
                    continue
                own = np.setxor1d(x, centre, assume_unique=True)
                if 2 * len(own) > len(x) + len(centre):
                    continue
                excess, reach = len(own) * plus - len(x) * minus, len(centre) * minus
                # documents in other components than the centre's have more than reach, all others no less than -reach
                other = reach if excess <= reach else -reach
                rest = 2 * plus * np.arange(len(own), 0, -1)
                rest = rest[rest >= excess + other]
                places.append(np.full(len(rest) + 1, i))
                tokens.append(np.r_[_by_rarity(own, classes)[: len(rest)], np.uint64(0)])
                excesses.append(np.full(len(rest) + 1, excess))
                rests.append(np.r_[rest, reach])
            if not places:
                continue
            at, token, excess, rest = map(np.concatenate, (places, tokens, excesses, rests))
            mark = np.cumsum([len(p) for p in places]) - 1
            none = np.zeros(len(at), bool)
            none[mark] = True
            for a in range(0, len(at), 100_000):
                cut = slice(a, a + 100_000)
                take = pa.array(at[cut])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("a").take(take), batch.column("b").take(take),
                     pa.array(token[cut].view(np.int64), mask=none[cut]), pa.array(excess[cut]), pa.array(rest[cut])],
                    ["id", "centre", "token", "excess", "rest"],
                )

    held = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    held = held.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    return held.select("a", "b", "text_a", "text_b").mapInArrow(
        differ, f"id {kind}, centre {kind}, token long, excess long, rest long"
    )


def _members(deltas: DataFrame) -> DataFrame:
    """(id, centre, links): documents of one text each, whether they link with their centre."""
    marks = deltas.filter("token is null").groupBy("id").agg(
        F.count("*").alias("times"), F.first("centre").alias("centre"), F.first(F.expr("excess <= rest")).alias("links")
    )
    return marks.filter("times = 1").drop("times")


def _akin(deltas: DataFrame, members: DataFrame, comps: DataFrame) -> DataFrame:
    """``deltas`` with comp, of the tokens that members of a family have in several components."""
    rows = deltas.filter("token is not null").join(members.select("id"), "id", "left_semi")
    placed = rows.join(comps, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    token = Window.partitionBy("centre", "token")
    placed = placed.withColumn("low", F.min("comp").over(token)).withColumn("high", F.max("comp").over(token))
    return placed.filter("low <> high").drop("low", "high")


def _across(links: DataFrame, comps: DataFrame) -> DataFrame:
    """``links`` (a, b) between different components."""
    for end in "ab":
        own = comps.select(F.col("id").alias(end), F.col("comp").alias(f"comp_{end}"))
        links = links.join(own, end, "left").withColumn(f"comp_{end}", F.coalesce(f"comp_{end}", end))
    return links.filter("comp_a <> comp_b").select("a", "b")


def near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 75,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    spark = docs.sparkSession
    work = Work(spark, "jaccard")
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")
    )
    # a shingle for about every six bytes
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(LARGEST, max(SMALLEST, (size // (6 * LOAD)).bit_length()))
    sketched = work.write(_sketched(rows, width, bits), "sketch")
    classes = _classes(sketched, bits)

    named = rows.filter("id is not null")
    shared_classes = spark.sparkContext.broadcast(classes)
    prefixes = _prefixes(named, shared_classes, width, percent)
    sorted_ = prefixes.repartition("token").sortWithinPartitions("token", "id")
    kind = dict(rows.dtypes)["id"]
    shared = sorted_.mapInArrow(
        _shared, f"token long, id {kind}, meta long, leader {kind}, leader_meta long"
    )
    shared = work.write(shared, "shared")

    votes = (
        shared.filter("id <> leader")
        .groupBy("id", "meta", "leader", "leader_meta")
        .agg(F.count("*").alias("shared"))
        .filter(_plausible("meta", "leader_meta", percent))
    )
    stars = votes.groupBy("id").agg(F.max(F.struct("shared", "leader")).alias("best"))
    stars = work.write(stars.select(F.col("id").alias("a"), F.col("best.leader").alias("b")), "stars")
    candidates = shared.select("id").distinct()
    texts = work.write(named.join(candidates, "id", "left_semi"), "texts")
    links = work.write(_verified(stars, texts, width, percent), "links")
    comps = components(links, work, "star")

    parities = work.write(_parities(texts, shared_classes, width), "parities")

    # other leaders: the documents that share most tokens of those left
    open_ = work.write(_open(shared.select("token", "id", "meta"), comps), "open0")
    work.drop("shared")
    stars = work.write(_popular(open_, percent), "popular")
    stars = work.write(_possible(stars, parities, percent), "near")
    found = work.write(_verified(stars, texts, width, percent), "more_links")
    if not found.isEmpty():
        links = links.unionByName(found)
        comps = components(links, work, "comps")
        open_ = work.write(_open(open_.drop("comp"), comps), "open1")
        work.drop("open0")

    # families: members link with their centre, or with each other by how they differ from it
    centres = work.write(_centres(open_, parities), "centres")
    deltas = work.write(_deltas(centres, texts, shared_classes, width, percent), "deltas")
    members = work.write(_members(deltas), "members")
    found = members.filter("links").select(F.col("id").alias("a"), F.col("centre").alias("b"))
    found = work.write(_across(found, comps), "family_links")
    if not found.isEmpty():
        links = links.unionByName(found)
        comps = components(links, work, "families")
    akin = work.write(_akin(deltas, members, comps), "akin")
    open_ = work.write(_open(open_.drop("comp"), comps, members), "open2")
    work.drop("deltas")
    left, right = akin.alias("l"), akin.alias("r")
    relatives = left.join(
        right,
        (F.col("l.centre") == F.col("r.centre")) & (F.col("l.token") == F.col("r.token"))
        & (F.col("l.comp") < F.col("r.comp"))
        & (F.least("l.rest", "r.rest") >= F.col("l.excess") + F.col("r.excess")),
    ).select(F.col("l.id").alias("a"), F.col("r.id").alias("b")).distinct()

    # what is left: pairs of no family with enough shared tokens in different components
    left, right = open_.alias("l"), open_.alias("r")
    pairs = (
        left.join(right, (F.col("l.token") == F.col("r.token")) & (F.col("l.comp") < F.col("r.comp"))
                  & F.coalesce(F.col("l.centre") != F.col("r.centre"), F.lit(True))
                  & (100 * F.shiftright("l.meta", 3) >= percent * F.shiftright("r.meta", 3))
                  & (100 * F.shiftright("r.meta", 3) >= percent * F.shiftright("l.meta", 3)))
        .groupBy(F.col("l.id").alias("a"), F.col("r.id").alias("b"),
                 F.col("l.meta").alias("ma"), F.col("r.meta").alias("mb"))
        .agg(F.count("*").alias("shared"))
        .filter(_plausible("ma", "mb", percent))
        .select("a", "b")
    )
    pairs = work.write(_possible(pairs.unionByName(relatives), parities, percent), "pairs")
    more = work.write(_verified(pairs, texts, width, percent), "more")
    ends = comps if more.isEmpty() else components(links.unionByName(more), work, "all")
    out = sketched.filter("slice is null").select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"))
    return out.join(ends.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("comp", "doc_id").alias("component_id")
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id."""
    gone = near_copies(docs, id_col, text_col).filter("component_id <> doc_id").select("doc_id").distinct()
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = docs.select(row, F.col(id_col).alias("ident"))
    return rows.join(gone, F.col("ident") == F.col("doc_id"), "left_anti").select("row.*")
