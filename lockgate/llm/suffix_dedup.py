"""Removal of repeated 100-byte strings, by deep-shallow sorting of suffixes.

Every string of ``length`` bytes has an anchor, its ``GRAM`` bytes of smallest hash; equal
strings have equal anchors at equal places. Neighbouring strings share their anchor, so a
document becomes a list of regions, each the strings of one anchor. Equal regions of one
chunk of texts are combined at once, so that a line repeated thousands of times sends one
row per chunk to its anchor. Regions meet where their anchors are equal; anchors that occur once drop out, and regions that are equal as a
whole keep one head. The strings of the heads that are left are suffixes cut at
``length`` bytes. They are sorted deep-shallow: multikey quicksort on eight bytes at a time
to ``SHALLOW`` words, and the groups with longer common prefixes by blind tries, which
look only at the words where a group branches. Equal neighbours in that order are
repeats; all but the first occurrence are removed.

An anchor in more than ``hot`` different regions would be a group for one task. Its
strings become rows of their own and are not sorted: the first occurrence of each is an
aggregate over its bytes, combined before the shuffle, and a join by bytes marks all others.
The most frequent strings, at most ``COMMON``, are broadcast for it, so that no task gets
all occurrences of a string.

Texts are UTF-8 bytes; null is empty. Order is by doc_id, then place; ids are unique, and
repeated rows (equal id and text) are one document, each with the same result. Rows without
an id are neither compared nor cut. Texts shorter than ``length`` stay as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lockgate.llm.common import Work
from lockgate.llm.rolling import Ranges, mixed

GRAM = 32
CHUNK = 1 << 20
SHALLOW = 3
PLACE = np.uint64((1 << 28) - 1)
BATCH = 150_000  # strings that are sorted at once, at least one anchor's
COMMON = 10_000


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbours."""
    out, have = values, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def regions(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text index, anchor hash, region hash, place) arrays over all texts.

    A place packs the first string's start, the number of strings and the anchor's offset.
    """
    held: list[int] = []
    size = 0
    for i, text in enumerate(texts):
        if len(text) >= length:
            held.append(i)
            size += len(text)
        if size >= CHUNK:
            yield _regions(texts, held, length)
            held, size = [], 0
    if held:
        yield _regions(texts, held, length)


def _regions(texts: list[bytes], held: list[int], length: int) -> tuple[np.ndarray, ...]:
    data = np.frombuffer(b"".join(texts[i] for i in held), np.uint8)
    sizes = np.array([len(texts[i]) for i in held])
    begins = np.cumsum(sizes) - sizes
    grams = np.arange(len(data) - GRAM + 1)
    hashes = Ranges(data).hash(grams, grams + GRAM)
    anchors = _smallest((hashes & ~PLACE) | grams.astype(np.uint64), length - GRAM + 1) & PLACE
    # strings that reach into the next text are none
    valid = np.ones(len(anchors), bool)
    for b in begins[1:]:
        valid[max(0, b - length + 1) : b] = False
    edge = np.r_[True, (anchors[1:] != anchors[:-1]) | (valid[1:] != valid[:-1])]
    low = np.flatnonzero(edge)
    high = np.r_[low[1:], len(anchors)] - 1
    low, high = low[valid[low]], high[valid[low]]
    anchor = anchors[low].astype(np.int64)
    offset = anchor - low
    whole = Ranges(data, 1).hash(low, high + length)
    whole = mixed(whole ^ (offset.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    which = np.searchsorted(begins, low, "right") - 1
    place = ((low - begins[which]) << 16) | ((high - low + 1) << 8) | offset
    return np.array(held)[which], hashes[anchor].view(np.int64), whole.view(np.int64), place


def _known(ids: np.ndarray, key: np.ndarray, whole: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Which regions of a chunk equal one of a smaller (id, place) in the same chunk."""
    by = np.lexsort((place, ids, whole, key))
    first = np.flatnonzero(np.r_[True, (key[by][1:] != key[by][:-1]) | (whole[by][1:] != whole[by][:-1])])
    head = by[np.repeat(first, np.diff(np.r_[first, len(by)]))]
    out = np.zeros(len(by), bool)
    out[by] = (ids[by] != ids[head]) | (place[by] != place[head])
    return out


def deep_shallow(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row order of the big-endian ``words`` (rows, columns), and a class for equal rows."""
    n, columns = words.shape
    order = np.arange(n)
    group = np.zeros(n, np.int64)
    for c in range(min(SHALLOW, columns)):  # multikey quicksort, a word at a time
        order, group = _split(words[:, c], order, group)
    # blind tries: a group is compared with its first row and branches where it first differs
    start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    active = np.flatnonzero(np.repeat(np.diff(np.r_[start, n]) > 1, np.diff(np.r_[start, n])))
    while len(active):
        rows, own = order[active], group[active]
        start = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        counts = np.diff(np.r_[start, len(own)])
        head = np.repeat(rows[start], counts)
        differs = words[rows] != words[head]
        first = np.where(differs.any(axis=1), differs.argmax(axis=1), columns)
        branch = np.repeat(np.minimum.reduceat(first, start), counts)
        more = branch < columns
        active, rows, own, branch = active[more], rows[more], own[more], branch[more]
        if not len(active):
            break
        key = words[rows, branch]
        by = np.lexsort((key, own))
        rows, key, own = rows[by], key[by], own[by]
        fresh = np.r_[True, (key[1:] != key[:-1]) | (own[1:] != own[:-1])]
        order[active] = rows
        # new group numbers are places in the order, which stay ascending
        at = active[fresh]
        group[active] = np.repeat(at, np.diff(np.r_[np.flatnonzero(fresh), len(active)]))
        size = np.diff(np.r_[np.flatnonzero(fresh), len(active)])
        active = active[np.repeat(size > 1, size)]
    return order, group


def _split(key: np.ndarray, order: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    by = np.lexsort((key[order], group))
    order, group = order[by], group[by]
    k = key[order]
    fresh = np.r_[True, (k[1:] != k[:-1]) | (group[1:] != group[:-1])]
    at = np.flatnonzero(fresh)
    return order, np.repeat(at, np.diff(np.r_[at, len(order)]))


def repeats(strings: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which rows of ``strings`` (rows, bytes) also occur at a smaller (id, start)."""
    n, length = strings.shape
    padded = np.zeros((n, -(-length // 8) * 8), np.uint8)
    padded[:, :length] = strings
    words = padded.view(">u8").astype(np.uint64)
    order, group = deep_shallow(words)
    # within equal rows by (id, start): the first stays, and what stands at the same place
    by = order[np.lexsort((starts[order], ids[order], group))]
    group = np.sort(group)
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    head = by[np.repeat(first, np.diff(np.r_[first, n]))]
    out = np.zeros(n, bool)
    out[by] = (ids[by] != ids[head]) | (starts[by] != starts[head])
    return out


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of regions sorted by anchor, region, id and place: those equal to an earlier one, and
    heads whose anchor has another region (``open``). Known copies pass through."""
    names = ["key", "id", "place", "open"]
    kept: pa.RecordBatch | None = None  # the last head, whose neighbour is not known yet
    before: int | None = None  # the anchor of the head before it
    for batch in batches:
        known = batch.filter(batch.column("known"))
        if known.num_rows:
            flags = pa.array(np.zeros(known.num_rows, bool))
            yield pa.RecordBatch.from_arrays([*(known.column(c) for c in names[:3]), flags], names)
            batch = batch.filter(pa.compute.invert(batch.column("known")))
        if not batch.num_rows:
            continue
        rows = batch if kept is None else pa.Table.from_batches([kept, batch]).combine_chunks().to_batches()[0]
        key, whole = rows.column("key").to_numpy(), rows.column("whole").to_numpy()
        ids, place = rows.column("id"), rows.column("place").to_numpy()
        copy = np.r_[False, (key[1:] == key[:-1]) & (whole[1:] == whole[:-1])]
        heads = np.flatnonzero(~copy)
        of = heads[np.cumsum(~copy) - 1]
        same_id = pa.compute.equal(ids, ids.take(pa.array(of))).to_numpy(zero_copy_only=False)
        copy &= ~(same_id & (place == place[of]))
        k = key[heads]
        near = np.r_[False, k[1:] == k[:-1]] | np.r_[k[1:] == k[:-1], False]
        near[0] |= before is not None and k[0] == before
        last = heads[-1]
        out = copy.copy()
        out[heads[:-1][near[:-1]]] = True
        cut = rows.filter(pa.array(out))
        yield pa.RecordBatch.from_arrays(
            [*(cut.column(c) for c in names[:3]), pa.array(~copy[out])], names
        )
        kept = rows.slice(last, 1)
        before = int(k[-2]) if len(k) > 1 else before
    if kept is not None and before is not None and kept.column("key")[0].as_py() == before:
        yield pa.RecordBatch.from_arrays(
            [*(kept.column(c) for c in names[:3]), pa.array([True])], names
        )


def _contexts(length: int):
    """Bytes of a document's open regions, or of each string in those that are ``single``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "id", "start", "strings", "bytes", "single"]
        for batch in batches:
            at, keys, starts, counts, held, alone, size = [], [], [], [], [], [], 0

            def out():
                return pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), batch.column("id").take(pa.array(at, pa.int64())),
                     pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(held, pa.binary()),
                     pa.array(alone, pa.bool_())], names)

            for i, (text, found) in enumerate(
                zip(batch.column("text").to_pylist(), batch.column("found").to_pylist(), strict=True)
            ):
                for f in found:
                    low, n = f["place"] >> 16, (f["place"] >> 8) & 255
                    spans = [(low + t, 1) for t in range(n)] if f["single"] else [(low, n)]
                    for start, m in spans:
                        own = text[start : start + m - 1 + length]
                        at.append(i)
                        keys.append(f["key"])
                        starts.append(start)
                        counts.append(m)
                        held.append(own)
                        alone.append(f["single"])
                        size += len(own)
                if size > 4 << 20:
                    yield out()
                    at, keys, starts, counts, held, alone, size = [], [], [], [], [], [], 0
            if at:
                yield out()

    return cut


def _removed(length: int):
    """Spans (id, start, end) of repeated strings among contexts sorted by key."""

    def work(table: pa.Table) -> pa.RecordBatch:
        n = table.column("strings").to_numpy()
        held = table.column("bytes").to_pylist()
        data = np.frombuffer(b"".join(held), np.uint8)
        begins = np.cumsum([0, *map(len, held)])[:-1]
        of = np.repeat(np.arange(len(n)), n)
        step = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        strings = np.lib.stride_tricks.sliding_window_view(data, length)[begins[of] + step]
        ids = table.column("id").combine_chunks()
        codes = pa.compute.rank(ids, "ascending", tiebreaker="dense").to_numpy().astype(np.int64)
        starts = table.column("start").to_numpy()[of] + step
        bad = repeats(strings, codes[of], starts)
        edge = np.r_[True, (of[1:] != of[:-1]) | (bad[1:] != bad[:-1])]
        first = np.flatnonzero(edge)
        last = np.r_[first[1:], len(of)] - 1
        first, last = first[bad[first]], last[bad[first]]
        return pa.RecordBatch.from_arrays(
            [ids.take(pa.array(of[first])), pa.array(starts[first]), pa.array(starts[last] + length)],
            ["id", "start", "end"],
        )

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += int(batch.column("strings").to_numpy().sum())
            if size < BATCH:
                continue
            table = pa.Table.from_batches(held)
            key = table.column("key").to_numpy()
            whole = int(np.searchsorted(key, key[-1]))  # the last anchor may go on
            if whole:
                yield work(table.slice(0, whole))
            held = table.slice(whole).to_batches()
            size = int(table.column("strings").to_numpy()[whole:].sum())
        if held:
            yield work(pa.Table.from_batches(held))

    return remove


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    for batch in batches:
        sizes, removed, runs, digests = [], [], [], []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            merged = merge([(s["start"], s["end"]) for s in spans or ()])
            digest, at = hashlib.sha256(), 0
            for a, b in merged:
                digest.update(text[at:a])
                at = b
            digest.update(text[at:])
            sizes.append(len(text))
            removed.append(sum(b - a for a, b in merged))
            runs.append(len(merged))
            digests.append(digest.hexdigest())
        longs = [pa.array(x, pa.int64()) for x in (sizes, removed, runs)]
        yield pa.RecordBatch.from_arrays([batch.column("id"), *longs, pa.array(digests, pa.string())], names)


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching spans."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _hot_spans(work: Work, strings: DataFrame, length: int) -> DataFrame:
    """Spans (id, start, end) of ``strings`` (id, start, bytes) but the first of equal bytes."""
    firsts = strings.groupBy("bytes").agg(F.min(F.struct("id", "start")).alias("head"), F.count("*").alias("n"))
    firsts = work.write(firsts.filter("n > 1"), "firsts")
    often = F.col("n") > strings.count() // COMMON  # fewer than COMMON strings, or all of few
    common, rare = F.broadcast(firsts.filter(often)), firsts.filter(~often)
    # common strings leave before the shuffle by bytes
    others = strings.join(F.broadcast(firsts.filter(often).select("bytes")), "bytes", "left_anti")
    met = strings.join(common, "bytes").unionByName(others.join(rare, "bytes"))
    return met.filter((F.col("id") != F.col("head.id")) | (F.col("start") != F.col("head.start"))).select(
        "id", "start", (F.col("start") + length).alias("end")
    )


def repeated_spans(docs: DataFrame, length: int = 100, hot: int = 5_000) -> DataFrame:
    """Spans (id, start, end), not merged, of ``docs`` (id, text as binary) to remove."""
    work = Work(docs.sparkSession, "suffix")
    kind = dict(docs.dtypes)["id"]

    def anchor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = pa.compute.rank(batch.column("id"), "ascending", tiebreaker="dense").to_numpy()
            for which, key, whole, place in regions(batch.column("text").to_pylist(), length):
                ids = batch.column("id").take(pa.array(which))
                known = _known(codes[which], key, whole, place)
                # copies that are known need not meet anyone: deal them out evenly
                deal = np.where(known, key ^ (whole + place * 31 + which), key)
                for a in range(0, len(which), 100_000):
                    cut = slice(a, a + 100_000)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x[cut]) for x in (deal, known, key, whole)]
                        + [ids[a : a + 100_000], pa.array(place[cut])],
                        ["deal", "known", "key", "whole", "id", "place"],
                    )

    named = docs.filter("id is not null")
    found = named.mapInArrow(
        anchor, f"deal long, known boolean, key long, whole long, id {kind}, place long"
    )
    found = found.repartition("deal").drop("deal")
    found = found.sortWithinPartitions("known", "key", "whole", "id", "place")
    met = work.write(found.mapInArrow(_heads, f"key long, id {kind}, place long, open boolean"), "met")
    heads = met.filter("open")
    many = heads.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > hot)
    many = work.write(many.select("key"), "many")
    any_hot = not many.isEmpty()

    # the texts are joined once, for the regions and for the strings of hot anchors
    marked = heads.join(many.withColumn("single", F.lit(True)), "key", "left")
    region = F.struct("key", "place", F.coalesce("single", F.lit(False)).alias("single"))
    listed = marked.groupBy("id").agg(F.collect_list(region).alias("found"))
    contexts = named.join(listed, "id").select("id", "text", "found").mapInArrow(
        _contexts(length), f"key long, id {kind}, start long, strings long, bytes binary, single boolean"
    )
    if any_hot:
        contexts = work.write(contexts, "contexts")
    whole = contexts.filter("not single").drop("single")
    sorted_ = whole.repartition("key").sortWithinPartitions("key")
    some = work.write(sorted_.mapInArrow(_removed(length), f"id {kind}, start long, end long"), "some")
    if any_hot:
        strings = contexts.filter("single").select("id", "start", "bytes")
        some = some.unionByName(_hot_spans(work, strings, length))
    start = F.shiftright("place", 16)
    end = start + F.shiftright("place", 8).bitwiseAND(255) - 1 + length
    return met.filter("not open").select("id", start.alias("start"), end.alias("end")).unionByName(some)


def deduplicated(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")
    )
    kind = dict(rows.dtypes)["id"]
    spans = repeated_spans(rows, length).groupBy("id").agg(
        F.collect_list(F.struct("start", "end")).alias("spans")
    )
    return rows.join(spans, "id", "left").select("id", "text", "spans").mapInArrow(
        _kept, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
