"""Language-model scores by online logistic context mixing over the bits of texts.

A text is a row of symbols. The ``head`` most frequent words (those seen more than ``RARE``
times) and the end are symbols of their own; any other word is an escape, its bytes and a space. Symbols have prefix codes
(Huffman's, of the words' counts, and one for bytes), so a frequent word takes few binary
decisions and every decision is predicted, mixed and paid for. The score is the log of the
probability of all of them, in the order of the text.

Static predictors look up how often a bit followed a hashed context: for words nothing, the
word before, the two words before, and the last very frequent word (which tells languages
apart); for bytes the last 1, 2, 3 and 5 symbols. One more predictor knows only what the
text itself has shown so far. A logistic mixer adds their stretched predictions with weights
picked by a gate (the kind of symbol and how sure two contexts are); an adaptive map
refines the result. Weights, map and the text's own predictor learn with every bit of the
text, from a common start, which is learnt online by every task from documents that the
tables have not seen and averaged over tasks. A text is walked in lanes of ``LANE`` symbols,
side by side: contexts reach across lanes, what was learnt along a lane doesn't.

Texts are walked on executors by ``Lanes.java``, lane after lane; here is the same in numpy, lanes
side by side, next to which it is tested, and all that is done once for the whole corpus.

What is gathered grows with the input: counts of all words, bits of all training documents,
the mixer's start from one in seven. The tables double with the training text up to
``2 ** table_bits`` slots a predictor (default 22: 4 MB each), the bound of what is
broadcast; beyond it contexts share slots. So are the ``head`` words (default 131,072); the
base score's counts of all others are joined.

Null text counts as empty: it has one token, its end. Repeated rows (equal id and text)
get equal scores, each on its own row. A null id is an id like others. Of very long texts
a task holds the bytes, the words outside the head and one lane. Without training documents known counts are 0, the
base score follows its formula, and predictors are all neutral. Other columns of the input
are not read, whatever their names.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lockgate.llm import jvm
from lockgate.llm.common import Work, remainder

PREDICTORS = 4
LANE = 256  # symbols
LANES = 768  # that start alike, side by side
SLICES = 16  # of one predictor's table
FAN = 16  # parts that one task adds up
LOCAL = 1024  # slots of a lane's own predictor
GATES = 32
CELLS = 49
FLUSH = 300_000  # words that a task counts together
TOPICS = 64
RARE = 3  # words seen no oftener are spelled, so that escapes are learnt
RATE = 0.015
LN10 = math.log(10)
END = b""
_MIX = np.uint64(0xD6E8FEB86659FD93)
_NODE = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Code:
    """Symbols: the head words (the end among them), then the escape, then 256 bytes."""

    index: dict[bytes, int]
    start: np.ndarray  # of each symbol's steps
    length: np.ndarray
    nodes: np.ndarray
    bits: np.ndarray

    @property
    def escape(self) -> int:
        return len(self.index)

    @classmethod
    def of(cls, words: list[bytes], counts: list[int], others: int) -> Code:
        letters = Counter(b"".join(words))
        spelled = [letters[b] + 1 + (len(words) if b == 32 else 0) for b in range(256)]
        steps = _steps([*(c + 1 for c in counts), others + 1], 0)
        steps += _steps(spelled, len(words) + 1)
        length = np.array([len(s) for s in steps])
        flat = np.array([x for s in steps for x in s], np.int64)
        return cls(
            {w: i for i, w in enumerate(words)}, np.cumsum(length) - length, length,
            flat >> 1, (flat & 1).astype(np.uint8),
        )


@dataclass
class Texts:
    """Texts as symbols, with the contexts of their tokens."""

    symbols: np.ndarray
    token: np.ndarray  # of each symbol
    first: np.ndarray  # each text's first symbol, and the end of all
    before: np.ndarray  # (3, tokens): contexts of words
    tails: list[Counter]  # words outside the head, by text


@dataclass
class Start:
    """Where every lane starts: weights by gate, and the adaptive map."""

    weights: np.ndarray  # (GATES, PREDICTORS + 1)
    map: np.ndarray  # (2 * CELLS)

    @classmethod
    def neutral(cls) -> Start:
        bins = 1 / (1 + np.exp(-(np.arange(CELLS) - CELLS // 2) / 2))
        return cls(np.full((GATES, PREDICTORS + 1), 0.3), np.tile(bins, 2))


def _steps(weights: list[int], base: int) -> list[list[int]]:
    """Prefix codes as steps ``2 * inner node + bit``; inner nodes are numbered from ``base``."""
    size = len(weights)
    heap = [(w, i) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    parent = [0] * (2 * size - 1)
    for node in range(size, 2 * size - 1):
        (a, left), (b, right) = heapq.heappop(heap), heapq.heappop(heap)
        parent[left], parent[right] = node << 1, node << 1 | 1
        heapq.heappush(heap, (a + b, node))
    steps = []
    for i in range(size):
        own, at = [], i
        while at != 2 * size - 2:
            own.append(((parent[at] >> 1) - size + base) << 1 | parent[at] & 1)
            at = parent[at] >> 1
        steps.append(own[::-1])
    return steps


def encode(texts: list[bytes], code: Code) -> Texts:
    """The symbols of whole texts, lower-cased, cut at white space."""
    escape, get, last = code.escape, code.index.get, code.index[END]
    ids: list[int] = []
    rest: list[bytes] = []
    sizes, tails = [], []
    for text in texts:
        words = text.lower().split()
        own = [get(w, escape) for w in words]
        tail = [w for w, i in zip(words, own, strict=True) if i == escape]
        ids += own
        ids.append(last)
        rest += tail
        sizes.append(len(own) + 1)
        tails.append(Counter(tail))
    tokens = np.array(ids, np.int64)
    spelled = tokens == escape
    width = np.ones(len(tokens), np.int64)
    width[spelled] = [len(w) + 2 for w in rest]
    at = np.cumsum(width) - width
    symbols = np.full(int(width.sum()), -1, np.int32)
    symbols[at] = tokens
    letters = np.frombuffer(b"".join(w + b" " for w in rest), np.uint8)
    symbols[symbols < 0] = letters.astype(np.int32) + escape + 1
    ends = np.cumsum(sizes)
    begins = ends - sizes
    # contexts of words: what precedes them in their own text
    name = (tokens.astype(np.uint64) + np.uint64(1)) * _NODE
    name[spelled] ^= np.array([zlib.crc32(w) for w in rest], np.uint64) * _MIX
    one = np.zeros_like(name)
    one[1:] = name[:-1]
    one[begins] = 0
    two = np.zeros_like(name)
    two[1:] = one[:-1]
    two[begins] = 0
    place = np.where(tokens < TOPICS, np.arange(len(tokens)), -1)
    place = np.maximum.accumulate(place)
    place[1:] = place[:-1].copy()
    place[0] = -1
    known = place >= np.repeat(begins, sizes)
    topic = np.where(known, tokens[place] + 1, 0).astype(np.uint64)
    before = np.stack([one, (one ^ (two * _NODE)) * _MIX, topic * _NODE])
    first = np.append(at[begins], len(symbols))
    return Texts(symbols, np.repeat(np.arange(len(tokens)), width), first, before, tails)


def lanes_of(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first symbol, symbols) of every lane: ``LANE`` symbols, counted from the text's start."""
    size = np.diff(texts.first)
    many = -(-size // LANE)
    text = np.repeat(np.arange(len(size)), many)
    turn = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    start = texts.first[text] + turn * LANE
    return text, start, np.minimum(texts.first[text + 1] - start, LANE)


@dataclass
class Bits:
    """The binary decisions of some lanes, one lane after the other."""

    bits: np.ndarray
    slots: np.ndarray  # (PREDICTORS, bits)
    own: np.ndarray  # slot in the lane's own predictor
    spelled: np.ndarray  # whether a byte is coded
    lane: np.ndarray
    size: np.ndarray  # bits of each lane


def decisions(texts: Texts, code: Code, text: np.ndarray, start: np.ndarray, size: np.ndarray, table_bits: int) -> Bits:
    """The decisions of consecutive lanes."""
    a, b = int(start[0]), int(start[-1] + size[-1])
    symbols, token = texts.symbols[a:b].astype(np.int64), texts.token[a:b]
    spelled = symbols > code.escape
    begin = texts.first[np.repeat(text, size)]
    here = np.arange(a, b)
    # bytes: the symbols before, within the text
    contexts = np.zeros((PREDICTORS, b - a), np.uint64)
    rolled = np.zeros(b - a, np.uint64)
    kept = 0
    for back in range(1, 6):
        at = here - back
        earlier = np.where(at >= begin, texts.symbols[np.maximum(at, 0)] + 1, 0).astype(np.uint64)
        rolled = (rolled + earlier) * _MIX
        rolled ^= rolled >> np.uint64(29)
        if back in (1, 2, 3, 5):
            contexts[kept] = rolled
            kept += 1
    word = ~spelled
    contexts[0, word] = 0
    contexts[1:, word] = texts.before[:, token[word]]
    many = code.length[symbols]
    of = np.repeat(np.arange(b - a), many)
    step = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many) + code.start[symbols][of]
    node = (code.nodes[step].astype(np.uint64) + np.uint64(1)) * _NODE
    slots = np.empty((PREDICTORS, len(of)), np.int32)
    for i in range(PREDICTORS):
        h = contexts[i].take(of)
        h ^= node
        h *= _MIX
        h ^= h >> np.uint64(31)
        h *= _NODE
        h >>= np.uint64(64 - table_bits)
        slots[i] = h
    spelled = spelled[of]
    # the text's own predictor shares a context with one of the others
    own = np.where(spelled, slots[2], slots[1]) & (LOCAL - 1)
    lane = np.repeat(np.repeat(np.arange(len(size), dtype=np.int32), size), many)
    return Bits(code.bits[step], slots, own, spelled, lane, np.bincount(lane, minlength=len(size)))


@dataclass
class Tables:
    """Stretched predictions in tenths; 0 where a context says nothing."""

    stretched: np.ndarray  # (PREDICTORS, slots) int8

    @property
    def table_bits(self) -> int:
        return self.stretched.shape[1].bit_length() - 1


#: How sure a prediction is, 0 to 3, by its byte: nothing, one sight, some, more.
SURE = np.searchsorted([1, 17, 31], np.abs(np.arange(256).astype(np.uint8).view(np.int8).astype(int)), side="right")


def quantised(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    stretched = np.log((ones + 0.25) / (zeros + 0.25)) * 10
    return np.clip(np.rint(stretched), -120, 120).astype(np.int8)


def mix(tables: Tables, bits: Bits, begin: Start) -> tuple[np.ndarray, Start, np.ndarray]:
    """ln of the probability of each lane; the mean of what lanes learnt, and how often gates were used.

    All lanes take their first decision, then their second, and so on.
    """
    lanes = len(bits.size)
    order = np.argsort(-bits.size, kind="stable")
    starts = (np.cumsum(bits.size) - bits.size)[order]
    longest = bits.size[order]
    live = np.searchsorted(-longest, -np.arange(int(longest[0])), side="left").tolist()
    turn = np.empty(len(bits.bits), np.int64)  # decisions by place in their lane
    a = 0
    for t, n in enumerate(live):
        np.add(starts[:n], t, out=turn[a : a + n])
        a += n
    lane = bits.lane[turn].astype(np.int64)
    x = np.empty((len(turn), PREDICTORS + 1), np.float32)
    gate = bits.spelled[turn] * 16 + lane * GATES
    for i in range(PREDICTORS):
        found = tables.stretched[i].take(bits.slots[i].take(turn))
        x[:, i] = found
        if i in (1, 2):
            gate += SURE.take(found.view(np.uint8)) * (4 if i == 1 else 1)
    x[:, :PREDICTORS] *= np.float32(0.1)
    own = bits.own[turn] + lane * LOCAL
    cell = bits.spelled[turn] * CELLS + lane * (2 * CELLS) + CELLS // 2
    ones = bits.bits[turn].astype(np.float32)
    step = np.float32(1.6) * ones - np.float32(0.8)
    finals = np.empty(len(turn), np.float32)
    weights = np.tile(begin.weights.astype(np.float32), (lanes, 1))
    whole = weights.view(f"V{weights.strides[0]}").ravel()
    refined = np.tile(begin.map.astype(np.float32), lanes)
    local = np.zeros(lanes * LOCAL, np.float32)
    a = 0
    for n in live:
        now = slice(a, a + n)
        a += n
        row, bit, g, place = x[now], ones[now], gate[now], own[now]
        state = local.take(place)
        row[:, PREDICTORS] = state
        w = weights.take(g, axis=0)
        dot = np.einsum("ni,ni->n", row, w)
        np.minimum(np.maximum(dot, -12, out=dot), 12, out=dot)
        p = 1 / (1 + np.exp(-dot))
        w += row * (RATE * (bit - p))[:, None]
        whole[g] = w.view(whole.dtype).ravel()  # a row at a time
        state *= np.float32(0.7)
        state += step[now]
        local[place] = state
        c = np.rint(dot + dot).astype(np.int64)
        c += cell[now]
        guess = refined.take(c)
        p += guess
        finals[now] = p
        refined[c] = guess + np.float32(0.02) * (bit - guess)
    finals = np.clip(finals / 2, 1e-5, 1 - 1e-5, dtype=np.float64)
    out = np.bincount(lane, np.log(np.where(ones > 0, finals, 1 - finals)), lanes)
    used = np.bincount(gate, minlength=lanes * GATES).reshape(lanes, GATES)
    mass = used.sum(axis=0)
    learnt = (weights.reshape(lanes, GATES, -1) * used[:, :, None]).sum(axis=0) / np.maximum(mass, 1)[:, None]
    learnt = np.where(mass[:, None] > 0, learnt, begin.weights)
    share = bits.size / bits.size.sum()
    return out, Start(learnt, share @ refined.reshape(lanes, -1)), mass


def _walked(texts: Texts, code: Code, table_bits: int, lanes: int = LANES) -> Iterator[tuple[np.ndarray, Bits]]:
    """(texts of lanes, their decisions), some lanes at a time."""
    text, start, size = lanes_of(texts)
    for a in range(0, len(text), lanes):
        part = slice(a, a + lanes)
        yield text[part], decisions(texts, code, text[part], start[part], size[part], table_bits)


def logs_of(texts: Texts, code: Code, tables: Tables, begin: Start) -> np.ndarray:
    """ln of the probability of every text."""
    out = np.zeros(len(texts.tails))
    for text, bits in _walked(texts, code, tables.table_bits):
        np.add.at(out, text, mix(tables, bits, begin)[0])
        del bits  # before the next ones are made
    return out


def _blobs(slice_: list[int], tables: list[np.ndarray]) -> pa.RecordBatch:
    blobs = [zlib.compress(np.ascontiguousarray(t).tobytes(), 1) for t in tables]
    return pa.RecordBatch.from_arrays([pa.array(slice_, pa.int32()), pa.array(blobs, pa.binary())], ["slice", "counts"])


def _packed(code: Code, base: np.ndarray, known: np.ndarray) -> bytes:
    """The code, and what tokens add to the base score and to the known ones, as ``Lanes.java`` reads them."""
    words = list(code.index)
    parts = [
        np.array([len(words), *map(len, words)], "<i4"), b"".join(words), code.length.astype("<i4"),
        (code.nodes << 1 | code.bits).astype("<i4"), base.astype("<f8"), known.astype(np.uint8),
    ]
    return b"".join(p if isinstance(p, bytes) else p.tobytes() for p in parts)


def _begun(start: Start) -> bytes:
    return np.append(start.weights.ravel(), start.map).astype("<f8").tobytes()


def _bit_counts(rows: DataFrame, packed, table_bits: int, work: Work, name: str) -> DataFrame:
    """(slice, counts): zeros and ones by slot, one row a slice, added up ``FAN`` parts at a time."""
    schema = "slice int, counts binary"

    def add(rows: pa.Table) -> pa.Table:
        total = np.zeros((2 << table_bits) // SLICES, np.float32)
        for blob in rows.column("counts"):
            held = zlib.decompress(blob.as_py())
            total += np.frombuffer(held, np.uint32)
        capped = np.minimum(total, 4e9).astype(np.uint32)
        own = pa.Table.from_batches([_blobs([rows.column("slice")[0].as_py()], [capped])])
        return own.append_column("lot", rows.column("lot").slice(0, 1))

    texts = rows.select("text")
    lots = texts.rdd.getNumPartitions()
    counting = jvm.made(rows.sparkSession, "Lanes$Counting", packed, table_bits)
    counts = jvm.mapped(texts, counting, schema).withColumn("lot", F.spark_partition_id())
    while True:
        lots = -(-lots // FAN)
        counts = counts.withColumn("lot", F.col("lot") % lots)
        counts = counts.groupBy("slice", "lot").applyInArrow(add, schema + ", lot int")
        if lots == 1:
            break
    return work.write(counts.select("slice", "counts"), name)


def _tables(counts: DataFrame, table_bits: int) -> Tables:
    """Tables of at most ``2 ** table_bits`` slots of a byte."""
    size = (1 << table_bits) // SLICES

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, blob in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                own = np.frombuffer(zlib.decompress(blob), np.uint32).reshape(-1, 2).astype(np.float64)
                yield _blobs([k], [quantised(own[:, 0], own[:, 1])])

    stretched = np.zeros((PREDICTORS * SLICES, size), np.int8)
    for r in counts.mapInArrow(shrink, "slice int, counts binary").toLocalIterator():
        stretched[r.slice] = np.frombuffer(zlib.decompress(r.counts), np.int8)
    return Tables(stretched.reshape(PREDICTORS, -1))


def _start(rows: DataFrame, packed, stretched, table_bits: int) -> Start:
    """The mean of what every task learnt online, gates weighted by their use."""
    begin = Start.neutral()
    learning = jvm.made(rows.sparkSession, "Lanes$Learning", packed, stretched, table_bits, _begun(begin))
    learnt = jvm.mapped(rows.select("text"), learning, "gate int, at int, mass double, value double")
    each = learnt.filter("mass > 0")
    means = each.groupBy("gate", "at").agg((F.sum(F.col("mass") * F.col("value")) / F.sum("mass")).alias("value"))
    for r in means.collect():  # GATES * (PREDICTORS + 1) + 2 * CELLS rows at most
        if r.gate < GATES:
            begin.weights[r.gate, r.at] = r.value
        else:
            begin.map[r.at] = r.value
    return begin


def scored(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    head: int = 131_072,
    table_bits: int = 22,
) -> DataFrame:
    """One row per document: counts, base_score, score and bits_per_byte."""
    spark = docs.sparkSession
    work = Work(spark, "lm")
    left = remainder(id_col, 7)
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        text.alias("text"),
        F.when(left == 2, 2).when(left == 3, 1).otherwise(0).alias("part"),
    )
    counted = jvm.mapped(rows.select("text", "part"), jvm.made(spark, "Lanes$Words", FLUSH), "word binary, n long")
    words = work.write(counted.groupBy("word").agg(F.sum("n").alias("c")), "words")
    sums = words.filter("c > 0").agg(F.sum("c"), F.count("*"), F.sum(F.col("c") * (F.length("word") + 1))).first()
    total, distinct, n_bytes = (v or 0 for v in sums)
    size = total + distinct + 1
    # fewer than 32 * head words are this frequent, so few reach the task that picks the head
    frequent = words.filter((F.col("c") > max(RARE, total // (32 * head))) & (F.length("word") > 0))
    top = [(bytes(r.word), r.c) for r in frequent.orderBy(F.col("c").desc(), "word").limit(head).collect()]
    ends = words.filter(F.length("word") == 0).first()
    top.append((END, ends.c if ends else 0))
    names, counts = [w for w, _ in top], [c for _, c in top]
    table_bits = min(max(16, math.ceil(math.log2(2 * max(n_bytes, 1)))), table_bits)
    code = Code.of(names, counts, total - sum(counts))
    heads = np.array(counts, float)
    base, seen = np.append(np.log10((heads + 1) / size), 0.0), np.append(heads > 0, False)
    packed = jvm.shared(spark, _packed(code, base, seen))

    main = _bit_counts(rows.filter("part = 0"), packed, table_bits, work, "bits")
    stretched = jvm.shared(spark, _tables(main, table_bits).stretched.tobytes())
    begin = _start(rows.filter("part = 1"), packed, stretched, table_bits)

    scoring = jvm.made(spark, "Lanes$Scoring", packed, stretched, table_bits, _begun(begin))
    kind = (
        "struct<n: bigint, n_bytes: bigint, n_known: bigint, base: double, ln: double,"
        " words: array<binary>, counts: array<bigint>>"
    )
    found = rows.select("doc_id", F.xxhash64("text").alias("hash"), jvm.called(spark, scoring, kind, F.col("text")).alias("s"))
    lines = work.write(found, "lines")
    done = lines.select(
        "doc_id", "hash", "s.n", F.lit(1).cast("long").alias("rows"), "s.n_bytes", "s.n_known", "s.base",
        (F.col("s.ln") / LN10).alias("score"),
    )
    rate = F.log10((F.col("c") + 1) / F.lit(float(size)))
    none = F.lit(0).cast("long")
    rest = lines.select("doc_id", "hash", F.explode(F.arrays_zip("s.words", "s.counts")).alias("w"))
    rest = rest.select("doc_id", "hash", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    tails = rest.join(words, "word").select(
        "doc_id", "hash", none.alias("n"), none.alias("rows"), none.alias("n_bytes"),
        F.when(F.col("c") > 0, F.col("n")).otherwise(0).alias("n_known"),
        (F.col("n") * rate).alias("base"), F.lit(0.0).alias("score"),
    )
    summed = done.unionByName(tails).groupBy("doc_id", "hash").agg(
        *(F.sum(c).alias(c) for c in ("n", "rows", "n_bytes", "n_known", "base", "score"))
    )
    each = F.explode(F.expr("array_repeat(0, cast(rows as int))"))
    return summed.select("*", each.alias("copy")).select(
        "doc_id",
        (remainder("doc_id", 7) == 2).alias("held_out"),
        (F.col("n") / F.col("rows")).cast("long").alias("n_tokens"),
        (F.col("n_known") / F.col("rows")).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") / F.col("rows")).alias("base_score"),
        (F.col("score") / F.col("rows")).alias("score"),
        (-F.col("score") * math.log2(10) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )
