"""Best-fit packing into fixed-length sequences by hierarchical residual packing.

Documents become pieces of at most ``capacity`` tokens. Every partition packs its pieces
best-fit, largest first, and emits the bins that are nearly full. Underfull bins go on as
items of their own fill: about ``fan_in`` partitions are merged and packed again, round by
round. Before each round, bins that not even the smallest one left would fit into are
emitted. A task gets about ``BINS`` bins or ``PIECES`` pieces, dealt in turn by fill so that
each has its share of large and small ones; the last round is the one that has no fewer
tasks than the round before it, or a single task. Bins carry pieces (ids and lengths),
never token ids.

Null text counts as empty: its only token is the end token, so every row has a piece.
Long documents are cut from the end, so that only their first piece may be shorter.
Repeated rows are separate documents. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lockgate.llm.common import Work
from lockgate.llm.tokens import Remembered, runs, segments_of

LATIN = "\u024f"
BINS, PIECES = 200_000, 1_000_000  # that a task of a later round gets

_tokenizers: dict = {}


def _tokenizer(path: str):
    if path not in _tokenizers:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _tokenizers[path] = Tokenizer.from_file(path)
    return _tokenizers[path]


def _ranked(ranks: str, pattern: str):
    if ranks not in _tokenizers:
        import base64

        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _tokenizers[ranks] = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={}
        )
    return _tokenizers[ranks]


def token_bytes(
    texts: list[str], path: str, end: int, ranks: tuple[str, str] | None = None
) -> list[bytes]:
    """Little-endian 32-bit ids of each text, the end token included.

    ``ranks`` names a file of ranks for the same vocabulary and its pattern; Latin
    segments without the sign ``<|`` of special strings are then encoded by it.
    """
    tokenizer = _tokenizer(path)

    def ids(part: list[str]) -> list[bytes]:
        out: list = [None] * len(part)
        if ranks:
            ordinary = _ranked(*ranks).encode_ordinary
            for i, s in enumerate(part):
                if s.isascii() and "<|" not in s or s and max(s) <= LATIN and "<|" not in s:
                    out[i] = np.array(ordinary(s), "<u4").tobytes()
        rest = [i for i, x in enumerate(out) if x is None]
        found = tokenizer.encode_batch([part[i] for i in rest], add_special_tokens=False)
        for i, e in zip(rest, found, strict=True):
            out[i] = np.array(e.ids, "<u4").tobytes()
        return out

    memory = Remembered(path, ids)
    cut = []
    for text in texts:
        own = segments_of(text)
        # all but the first segment begin with the space at which they were cut
        cut.append(own[:1] + [f" {s}" for s in own[1:]])
    table = memory.table(set().union(*cut) if cut else set())
    tail = np.array([end], "<u4").tobytes()
    return [b"".join([*map(table.__getitem__, c), tail]) for c in cut]


def pieces_of(ids: bytes, capacity: int) -> list[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of a document's ids."""
    n = len(ids) // 4
    first = (n - 1) % capacity + 1
    bounds = [0, *range(first, n + 1, capacity)]
    return [
        (k, a, b - a, zlib.crc32(ids[4 * a : 4 * b]))
        for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False))
    ]


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Indices in bins: largest first, each into the fullest bin that still takes it."""
    spaces: list[int] = []  # distinct free spaces, ascending
    by_space: dict[int, list[list[int]]] = {}
    bins: list[list[int]] = []
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        at = bisect_left(spaces, need)
        if at < len(spaces):
            space = spaces[at]
            held = by_space[space]
            target = held.pop()
            if not held:
                del by_space[space]
                spaces.pop(at)
        else:
            space, target = capacity, []
            bins.append(target)
        target.append(i)
        left = space - need
        if left:
            if left not in by_space:
                by_space[left] = []
                spaces.insert(bisect_left(spaces, left), left)
            by_space[left].append(target)
    return bins


PIECE = "doc_id {kind}, piece int, start long, length long, ids_crc32 long"


def _packer(capacity: int, full: int, last: bool):
    """Rows (fill, members) in; the same out with ``done`` for bins that need no more.

    ``turn`` counts a task's bins that go on, by fill.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = list(batches)
        if not tables:
            return
        table = pa.Table.from_batches(tables).combine_chunks()
        fill = table.column("fill").to_numpy()
        members = table.column("members").combine_chunks()
        if isinstance(members, pa.ChunkedArray):
            members = members.chunk(0)
        bins = best_fit(fill, capacity)
        order = np.fromiter((i for b in bins for i in b), np.int64, len(fill))
        taken = members.take(pa.array(order))
        sizes = np.diff(taken.offsets.to_numpy())
        ends = np.cumsum([len(b) for b in bins])
        per_bin = np.add.reduceat(sizes, np.r_[0, ends[:-1]])
        filled = np.add.reduceat(fill[order], np.r_[0, ends[:-1]])
        offsets = np.r_[0, np.cumsum(per_bin)].astype(np.int32)
        packed = pa.ListArray.from_arrays(pa.array(offsets), taken.flatten())
        done = np.ones(len(bins), bool) if last else filled >= full
        turn = np.zeros(len(bins), np.int64)
        more = np.flatnonzero(~done)
        turn[more[np.argsort(filled[more], kind="stable")]] = np.arange(len(more))
        for a in range(0, len(bins), 5000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[a : a + 5000]) for x in (filled.astype(np.int64), done, turn)]
                + [packed.slice(a, 5000)],
                ["fill", "done", "turn", "members"],
            )

    return pack


def pack(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 1024,
    end: int = 2,
    full_share: float = 0.995,
    fan_in: int = 8,
    ranks: tuple[str, str] | None = None,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    work = Work(docs.sparkSession, "pack")
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    piece = PIECE.format(kind=dict(rows.dtypes)["doc_id"])
    schema = f"fill long, members array<struct<{piece.replace(' ', ':', 1).replace(', ', ',').replace(' int', ':int').replace(' long', ':bigint')}>>"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            split = [
                pieces_of(x, capacity)
                for run in runs(texts)
                for x in token_bytes(texts[run], path, end, ranks)
            ]
            counts = np.fromiter(map(len, split), np.int64, len(split))
            flat = np.array([p for s in split for p in s], np.int64).reshape(-1, 4)
            ids = batch.column("doc_id").take(pa.array(np.repeat(np.arange(len(split)), counts)))
            one = pa.StructArray.from_arrays(
                [ids, pa.array(flat[:, 0].astype(np.int32)), *(pa.array(flat[:, k]) for k in (1, 2, 3))],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1, dtype=np.int32)), one)
            yield pa.RecordBatch.from_arrays([pa.array(flat[:, 2]), lists], ["fill", "members"])

    full = int(capacity * full_share)
    out = f"fill long, done boolean, turn long, {schema.split(', ', 1)[1]}"
    finished = []
    width, level = 0, 0
    first = _packer(capacity, full, False)
    bins = rows.mapInArrow(lambda batches: first(cut(batches)), out)
    while True:
        bins = work.write(bins.withColumn("place", F.spark_partition_id()), f"round{level}")
        left = bins.filter(~F.col("done"))
        # at most a row for each fill
        fills = left.groupBy("fill").agg(
            F.count("*").alias("bins"), F.sum(F.size("members")).alias("pieces"), F.max("place").alias("place")
        ).collect()
        # a bin that the smallest one left does not fit into takes no other either
        room = capacity - min((r.fill for r in fills), default=capacity)
        finished.append(
            bins.filter(F.col("done") | (F.col("fill") > room)).select(F.lit(level).alias("level"), "members")
        )
        fills = [r for r in fills if r.fill <= room]
        if not fills:
            break
        need = max(-(-sum(r.bins for r in fills) // BINS), -(-sum(r.pieces for r in fills) // PIECES))
        before = width or max(r.place for r in fills) + 1
        width = max(-(-before // fan_in), need)
        last = width == 1 or width >= before
        # each task before deals its bins out by fill, from another place on
        deal = F.pmod(F.col("turn") + F.col("place"), F.lit(width))
        items = left.filter(F.col("fill") <= room).repartition(width, deal).select("fill", "members")
        bins = items.mapInArrow(_packer(capacity, full, last), out)
        level += 1
    bins = finished[0]
    for more in finished[1:]:
        bins = bins.unionByName(more)
    placed = bins.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn(
        "offsets",
        F.expr(
            "aggregate(members, named_struct('at', 0L, 'all', array_repeat(0L, 0)),"
            " (s, m) -> named_struct('at', s.at + m.length, 'all', array_append(s.all, s.at)), s -> s.all)"
        ),
    )
    zipped = F.explode(F.arrays_zip("members", "offsets")).alias("z")
    return placed.select("sequence_id", zipped).select(
        "z.members.*", "sequence_id", F.col("z.offsets").alias("offset")
    )
