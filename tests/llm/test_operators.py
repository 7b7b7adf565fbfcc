"""The text operators against brute force on a small table full of awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lockgate.llm import (
    exact_dedup,
    jaccard,
    language,
    jvm,
    lm_scoring,
    mixing,
    packing,
    quality_rules,
    suffix_dedup,
    tokens,
    toxicity,
)
from lockgate.llm.common import Work

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, __row string, __id long, key long"
BPE = public_tokenizers.path("byte_bpe_50k.json")
RANKS = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def texts():
    rng = random.Random(4)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(150)]
    prose = [" ".join(rng.choices(vocabulary, k=rng.randint(3, 160))) for _ in range(40)]
    edited = []
    for p in prose[:8]:
        for _ in range(4):
            words = p.split()
            for _ in range(len(words) // 25):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            edited.append(" ".join(words))
    odd = ["", None, " ", "\n\t ", "a", "A b", "one two three four", "x" * 5000, "ab " * 900,
           "  two  spaces  \n", "été à ▁   次 😀 <|endoftext|> </s>", "line\nline\nline\n\nline", *[prose[0]] * 5,
           prose[1].upper(), prose[2].replace(" ", "\n"), " ".join(prose[3:9]) * 3]
    return prose + edited + odd


ROWS = [
    (i, t, ["en", "de", None][i % 3], [None, "s0", "s0", "s1"][i % 4], 0, "x", i, 1)
    for i, t in enumerate(texts())
]


@pytest.fixture(scope="module")
def docs(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    yield spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(i, i % 2, int(i % 5 == 0)) for i, *_ in ROWS] + [(None, 1, 1), (3, None, None)],
        "doc_id long, quality int, toxic int",
    )


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(frame):
    return {r.doc_id: r for r in frame.collect()}


def shingles(text):
    words = WORD.findall(text.lower()) if text else []
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def test_near_copies(docs):
    sets = {i: shingles(t) for i, t, *_ in ROWS}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    found = by_id(jaccard.near_copies(docs))
    assert {i: (len(s), find(i)) for i, s in sets.items()} == {
        i: (r.n_shingles, r.component_id) for i, r in found.items()
    }
    kept = jaccard.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i in sets if find(i) == i}


def test_parity_bitmaps_never_exceed_the_difference():
    rng = np.random.default_rng(1)
    for n in (5, 70, 900):
        a = set(rng.integers(0, 1 << 40, n).tolist())
        b = set(list(a)[: n // 2]) | set(rng.integers(0, 1 << 40, n // 3).tolist())

        def bits(s, places):
            at = np.array(list(s)) & (places - 1)
            return np.packbits((np.bincount(at, minlength=places) & 1).astype(np.uint8)).tobytes()

        assert jaccard.difference_at_least(bits(a, 1024), bits(b, 256)) <= len(a ^ b)


def test_families_below_the_threshold_are_not_paired(spark, monkeypatch):
    rng = random.Random(11)
    base = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(200)]
    rows = []
    for i in range(160):
        words = list(base)
        for _ in range((2 if i % 2 else 10) if i > 3 else 0):  # about 0.9 and 0.62 similar to the base
            words[rng.randrange(len(words))] = f"new{rng.random()}"
        rows.append((i, " ".join(words)))
    rows.append((160, rows[12][1] + " one more"))  # links with a member, not with the base
    rows += [(161, rows[6][1]), (161, rows[8][1])]  # rows of one id
    rows.append((162, rows[10][1]))
    seen, possible = [], jaccard._possible
    monkeypatch.setattr(
        jaccard, "_possible", lambda pairs, *args: seen.append(pairs.count()) or possible(pairs, *args)
    )
    found = by_id(jaccard.near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)))

    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in rows}
    for _ in range(8):
        for i, x in sets:
            for j, y in sets:
                if 100 * len(x & y) >= 75 * len(x | y):
                    root[i] = root[j] = min(root[i], root[j])
    assert len(set(root.values())) > 50
    assert root == {i: r.component_id for i, r in found.items()}
    assert seen[-1] < 10 * len(rows)  # 80 documents stay alone: 80 * 160 pairs with all others


def test_a_task_walks_few_lanes_at_a_time(monkeypatch):
    held, mix = [], lm_scoring.mix
    monkeypatch.setattr(lm_scoring, "mix", lambda t, bits, b: held.append(len(bits.size)) or mix(t, bits, b))
    code = lm_scoring.Code.of([b"a", b"b", lm_scoring.END], [3, 2, 1], 1)
    tables = lm_scoring.Tables(np.zeros((lm_scoring.PREDICTORS, 1 << 16), np.int8))

    def logs(texts):
        return lm_scoring.logs_of(lm_scoring.encode(texts, code), code, tables, lm_scoring.Start.neutral())

    many = logs([b"a b c " * 100] * 1000)
    assert np.array_equal(many, np.repeat(logs([b"a b c " * 100]), 1000)) and max(held) <= 768


def test_exact_groups(docs):
    norm = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for i, t, *_ in ROWS}
    groups = {}
    for i, n in norm.items():
        groups.setdefault(n, []).append(i)
    expected = {
        i: (min(groups[n]), len(groups[n]), i == min(groups[n]), hashlib.sha256(n.encode()).hexdigest())
        for i, n in norm.items()
    }
    found = by_id(exact_dedup.exact_groups(docs, bucket_keys=3, start_depth=1, max_depth=8))
    assert expected == {i: (r.keep_id, r.group_size, r.kept, r.text_sha256) for i, r in found.items()}
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(min(g) for g in groups.values())


def test_the_directory_of_the_index_decides(spark, docs):
    work = Work(spark, "directory")
    index, found = exact_dedup.dedup_index(docs, work, bucket_keys=3, start_depth=1)
    entries, slots = index.collect(), found.slots.collect()
    # buckets are cut as deep as they need, and no deeper
    sizes = Counter((r.depth, r.bucket) for r in entries)
    assert max(sizes.values()) <= 3 and len({depth for depth, _ in sizes}) > 1
    for depth, bucket in sizes:
        above = sum(1 for r in entries if (r.key % 2**64) >> (65 - depth) == bucket >> 1)
        assert depth == 1 or above > 3
    for r in slots:
        assert r.bucket == r.slot >> (found.bits - r.depth)
    texts = docs.select(F.col("doc_id").alias("id"), exact_dedup.normalised(F.col("text")).alias("norm"))
    texts = texts.select("id", F.xxhash64("norm").alias("key"), "norm")
    groups = exact_dedup.chained(texts, found)
    assert groups.agg(F.sum("group_size")).first()[0] == len(ROWS)
    # a directory that lacks a slot, or names two buckets for one, loses rows or splits chains
    slot = slots[0].slot
    lacking = exact_dedup.Directory(found.slots.filter(F.col("slot") != slot), found.bits)
    assert exact_dedup.chained(texts, lacking).agg(F.sum("group_size")).first()[0] < len(ROWS)
    double = found.slots.unionByName(found.slots.withColumn("bucket", -1 - F.col("bucket")))
    assert exact_dedup.chained(texts, exact_dedup.Directory(double, found.bits)).count() == 2 * len(entries)


def test_a_directory_doubles_until_its_buckets_fit(spark):
    work = Work(spark, "doubling")
    # keys that differ in their last bits only
    keys = spark.range(40).select((F.col("id") + 5_000_000_000).alias("key"))
    found = exact_dedup.directory(keys, work, bucket_keys=3, start_depth=4)
    assert found.bits == 64
    rows = found.look_up(keys).collect()
    assert len(rows) == 40 and max(Counter((r.depth, r.bucket) for r in rows).values()) <= 3
    with pytest.raises(ValueError, match="bits"):
        exact_dedup.directory(keys, work, 3, start_depth=0)


def test_repeated_strings(docs):
    seen, expected = set(), {}
    for i, t, *_ in ROWS:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - 99):
            if data[s : s + 100] in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(data[s : s + 100])
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        runs = len(bytes(gone).replace(b"\0", b" ").split())
        expected[i] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    found = by_id(suffix_dedup.deduplicated(docs))
    assert expected == {i: tuple(r)[1:] for i, r in found.items()}


def test_hot_anchors_are_split(docs):
    rows = docs.selectExpr("doc_id AS id", "cast(coalesce(text, '') AS binary) AS text")
    plain = {(r.id, r.start, r.end) for r in suffix_dedup.repeated_spans(rows).collect()}
    dealt = {(r.id, r.start, r.end) for r in suffix_dedup.repeated_spans(rows, hot=1).collect()}

    def covered(spans):
        return {(i, x) for i, a, b in spans for x in range(a, b)}

    assert covered(plain) == covered(dealt)


@pytest.mark.parametrize("common", [1, 10_000])
def test_a_hot_string_is_reduced_before_it_is_compared(spark, monkeypatch, common):
    tables = {}
    write = Work.write

    def kept(self, frame, name):
        tables[name] = write(self, frame, name)
        return tables[name]

    monkeypatch.setattr(Work, "write", kept)
    monkeypatch.setattr(suffix_dedup, "COMMON", common, raising=False)
    rng = random.Random(8)
    passage = "".join(rng.choices("abcdefgh", k=150))
    rows = [
        (i, ("".join(rng.choices("ijklmnop", k=120)) + passage + "".join(rng.choices("ijklmnop", k=120))).encode())
        for i in range(60)
    ]
    docs = spark.createDataFrame(rows, "id long, text binary").repartition(4)
    spans = suffix_dedup.repeated_spans(docs, hot=20).collect()
    covered = {(r.id, x) for r in spans for x in range(r.start, r.end)}
    seen, expected = set(), set()
    for i, t in rows:
        for a in range(len(t) - 99):
            if t[a : a + 100] in seen:
                expected.update((i, x) for x in range(a, a + 100))
            seen.add(t[a : a + 100])
    assert covered == expected and {(i, x) for i in range(1, 60) for x in range(120, 270)} <= covered
    firsts = tables["firsts"].collect()
    assert len({bytes(r.bytes) for r in firsts}) == len(firsts)
    assert max(r.n for r in firsts) == 60 and all(r.head.id == 0 for r in firsts if r.n == 60)


def test_deep_shallow_order():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 3, (400, 7)).astype(np.uint64)
    words[:, :4] = words[0, :4]
    order, group = suffix_dedup.deep_shallow(words)
    rows = [tuple(words[i]) for i in order]
    classes = {}
    for row, g in zip(rows, group, strict=True):
        assert classes.setdefault(g, row) == row
    assert len(classes) == len(set(rows))


def test_token_counts(docs):
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    found = by_id(tokens.token_counts(docs, PIECES))
    for i, t, *_ in ROWS:
        n = len(own.encode(t or ""))
        assert tuple(found[i])[1:] == (len((t or "").encode()), n, n > 4096)


def test_packing(docs):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(BPE)
    rows = packing.pack(docs, BPE, capacity=64, fan_in=2, ranks=RANKS).collect()
    places, pieces = {}, {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault(r.doc_id, []).append(r)
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 64
    total = 0
    for i, t, *_ in ROWS:
        ids = np.array([*own.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        total += len(ids)
        at = 0
        for k, r in enumerate(sorted(pieces[i], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at) and (k == 0 or r.length == 64)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    assert len(places) <= math.ceil(total / 64) * 1.03 + 1


@pytest.mark.parametrize("small", [0, 60])
def test_packing_leaves_no_task_with_all_bins(spark, monkeypatch, small):
    rounds = {}
    write = Work.write

    def kept(self, frame, name):
        rounds[name] = write(self, frame, name)
        return rounds[name]

    monkeypatch.setattr(Work, "write", kept)
    monkeypatch.setattr(packing, "BINS", 50, raising=False)
    rows = [(i, "a b c d e f " * (6 if i < 300 else 1)) for i in range(300 + small)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = packing.pack(docs, BPE, capacity=64, fan_in=2, ranks=RANKS).collect()
    assert sorted({r.doc_id for r in found}) == [i for i, _ in rows]
    held = Counter()
    for r in found:
        held[r.sequence_id] += r.length
    assert max(held.values()) <= 64
    assert len(held) == 300
    later = [f for name, f in rounds.items() if name != "round0"]
    if not small:
        assert not later  # no bin takes another
    for f in later:
        # a hash deals the parts out, so that a task may get several
        assert max(r["count"] for r in f.groupBy("place").count().collect()) < 200


def test_mixing(docs):
    rows = [r.asDict() for r in mixing.mix(docs).collect()]
    source = {i: s for i, _, _, s, *_ in ROWS}
    sizes, taken, target = Counter(), Counter(), {}
    for r in rows:
        s = source[r["doc_id"]]
        assert r["size"] == len(WORD.findall(ROWS[r["doc_id"]][1] or ""))
        assert 0 <= r["taken"] <= 2 * r["size"]
        sizes[s] += r["size"]
        taken[s] += r["taken"]
        target[s] = r["target"]
    weights = dict(zip(["s0", "s1", None], (5, 2, 1), strict=True))
    expected, left, open_ = {}, 1.5 * sum(sizes.values()), set(weights)
    while open_:
        unit = left / sum(weights[s] for s in open_)
        over = {s for s in open_ if unit * weights[s] > 2 * sizes[s]}
        if not over:
            expected |= {s: unit * weights[s] for s in open_}
            break
        expected |= {s: 2 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        open_ -= over
    for s in weights:
        assert target[s] == pytest.approx(expected[s]) and abs(taken[s] - target[s]) <= 1
    again = mixing.mix(docs.repartition(5)).collect()
    assert {r.doc_id: r.taken for r in again} == {r["doc_id"]: r["taken"] for r in rows}
    assert mixing.mixed_documents(docs).columns == docs.columns


def test_quality_statistics(docs, labels, spark):
    rules = quality_rules.learn_from(docs, labels, Work(spark, "test"))
    found = by_id(quality_rules.judged(docs, rules))
    for i, t, *_ in ROWS:
        words = WORD.findall(t or "")
        windows = list(zip(words, words[1:], words[2:], strict=False))
        counts = Counter(windows)
        covered = {k + d for k, w in enumerate(windows) if counts[w] > 1 for d in range(3)}
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        symbols = sum(c in "#*$%&|<>" for c in t or "")
        assert tuple(found[i])[1:7] == (
            len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed
        )
        assert not (failed and found[i].kept)


def test_decision_list_learns_a_threshold(spark):
    rows = [(i % 100 / 100, 0.0, 0.0, 5.0, 100.0, 0.9, int(i % 100 < 80), i % 3 == 0) for i in range(900)]
    columns = [*quality_rules.FEATURES, "quality", "prune"]
    learnt = quality_rules.learn(spark.createDataFrame(rows, columns))
    ((name, sign, cut),) = learnt.rules[0].conditions
    assert (name, sign) == ("symbol_share", ">") and 0.75 <= cut <= 0.8


def test_scores_of_the_language_model(docs):
    counts, total = Counter(), 0
    for i, t, *_ in ROWS:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            own = [*(t or "").encode().lower().split(), b""]
            counts.update(own)
            total += len(own)
    found = by_id(lm_scoring.scored(docs, head=20))
    for i, t, *_ in ROWS:
        own = [*(t or "").encode().lower().split(), b""]
        base = sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in own)
        r = found[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[w] > 0 for w in own), total)
        assert r.base_score == pytest.approx(base) and r.score < 0


def small_model(table_bits=12):
    rng = np.random.default_rng(3)
    code = lm_scoring.Code.of([b"the", b"of", b""], [30, 20, 9], 40)
    zeros, ones = (rng.integers(0, 9, (lm_scoring.PREDICTORS, 1 << table_bits)).astype(float) for _ in range(2))
    return code, lm_scoring.Tables(lm_scoring.quantised(zeros, ones)), lm_scoring.Start.neutral()


def test_bits_of_texts_are_a_probability():
    code, tables, begin = small_model()
    every = [b"", b"the", b"of", *(bytes([c]) for c in range(256) if not bytes([c]).isspace() and not 65 <= c <= 90)]
    logs = lm_scoring.logs_of(lm_scoring.encode(every, code), code, tables, begin)
    assert 0 < np.exp(logs).sum() < 1


def test_lanes_are_mixed_as_one_bit_after_the_other():
    code, tables, begin = small_model()
    own = ["the of the zebra of zebra the".encode(), b"", b"of of of the the quagga " * 150]
    texts = lm_scoring.encode(own, code)
    expected = np.zeros(len(own))
    for text, bits in lm_scoring._walked(texts, code, tables.table_bits):
        at = 0
        for lane, many in enumerate(bits.size):
            weights, refined, local = begin.weights.copy(), begin.map.copy(), Counter()
            for k in range(at, at + many):
                slots, place, bit = bits.slots[:, k], bits.own[k], int(bits.bits[k])
                x = np.array([*(tables.stretched[i, slots[i]] / 10 for i in range(lm_scoring.PREDICTORS)), local[place]])
                sure = [lm_scoring.SURE[int(tables.stretched[i, slots[i]]) % 256] for i in (1, 2)]
                gate = bits.spelled[k] * 16 + sure[0] * 4 + sure[1]
                dot = min(max(float(x @ weights[gate]), -12), 12)
                p = 1 / (1 + math.exp(-dot))
                weights[gate] += lm_scoring.RATE * (bit - p) * x
                local[place] = 0.7 * local[place] + 1.6 * (bit - 0.5)
                cell = bits.spelled[k] * lm_scoring.CELLS + lm_scoring.CELLS // 2 + round(dot * 2)
                final = min(max((p + refined[cell]) / 2, 1e-5), 1 - 1e-5)
                refined[cell] += 0.02 * (bit - refined[cell])
                expected[text[lane]] += math.log(final if bit else 1 - final)
            at += many
    found = lm_scoring.logs_of(texts, code, tables, begin)
    assert found == pytest.approx(expected, rel=1e-3)


def test_a_text_scores_alike_in_any_company():
    code, tables, begin = small_model()
    own = [b"the zebra of the quagga", b"of " * 700, b"", b"x" * 3000, b"the zebra of the quagga"]
    together = lm_scoring.logs_of(lm_scoring.encode(own, code), code, tables, begin)
    alone = [lm_scoring.logs_of(lm_scoring.encode([t], code), code, tables, begin)[0] for t in own]
    assert together == pytest.approx(alone, rel=1e-6)


def test_executors_walk_texts_as_numpy_does(spark):
    code, tables, begin = small_model()
    own = [b"The zebra\x0bof the quagga", b"", "\u00fcber\u2028the \x85 of\x00x".encode(), b"x" * 3000 + b" of", b"of the zebra " * 70_000]
    texts, bits = lm_scoring.encode(own, code), tables.table_bits
    frame = spark.createDataFrame([(bytearray(t), i) for i, t in enumerate(own)], "text binary, part int").coalesce(1)
    base, seen = np.array([-1.0, -2.0, -0.5, 0.0]), np.array([1, 0, 1, 0])
    packed = jvm.shared(spark, lm_scoring._packed(code, base, seen))
    stretched, start = jvm.shared(spark, tables.stretched.tobytes()), lm_scoring._begun(begin)

    kind = (
        "struct<n: bigint, n_bytes: bigint, n_known: bigint, base: double, ln: double,"
        " words: array<binary>, counts: array<bigint>>"
    )
    scoring = jvm.made(spark, "Lanes$Scoring", packed, stretched, bits, start)
    found = frame.select("part", jvm.called(spark, scoring, kind, F.col("text")).alias("s")).select("part", "s.*")
    logs = lm_scoring.logs_of(texts, code, tables, begin)
    for r in found.collect():
        words = [*own[r.part].lower().split(), b""]
        at = [code.index.get(w, code.escape) for w in words]
        assert (r.n, r.n_bytes, r.n_known) == (len(at), len(own[r.part]), int(seen[at].sum()))
        assert r.base == pytest.approx(base[at].sum()) and r.ln == pytest.approx(logs[r.part], rel=1e-4)
        assert dict(zip(map(bytes, r.words), r.counts)) == texts.tails[r.part]

    expected = np.zeros((lm_scoring.PREDICTORS, 2 << bits), np.uint32)
    learnt, mass = begin, np.zeros(lm_scoring.GATES)
    for _, part in lm_scoring._walked(texts, code, bits):
        for i in range(lm_scoring.PREDICTORS):
            np.add.at(expected[i], part.slots[i] * 2 + part.bits, np.uint32(1))
        _, learnt, used = lm_scoring.mix(tables, part, learnt)
        mass += used
    counted = jvm.mapped(frame, jvm.made(spark, "Lanes$Counting", packed, bits), "slice int, counts binary")
    counts = np.zeros((lm_scoring.PREDICTORS * lm_scoring.SLICES, expected.shape[1] // lm_scoring.SLICES), np.uint32)
    for r in counted.collect():
        counts[r.slice] = np.frombuffer(zlib.decompress(r.counts), np.uint32)
    assert (counts.reshape(expected.shape) == expected).all()

    learning = jvm.made(spark, "Lanes$Learning", packed, stretched, bits, start)
    rows = jvm.mapped(frame, learning, "gate int, at int, mass double, value double").collect()
    values = {(r.gate, r.at): r.value for r in rows}
    gates = np.array([[values[g, i] for i in range(lm_scoring.PREDICTORS + 1)] for g in range(lm_scoring.GATES)])
    assert gates == pytest.approx(learnt.weights, abs=1e-4)
    assert [values[lm_scoring.GATES, i] for i in range(2 * lm_scoring.CELLS)] == pytest.approx(learnt.map, abs=1e-4)
    assert {(r.gate, r.mass) for r in rows if r.gate < lm_scoring.GATES} == set(enumerate(mass))

    words = Counter()
    for r in jvm.mapped(frame, jvm.made(spark, "Lanes$Words", 3), "word binary, n long").collect():
        words[bytes(r.word)] += r.n
    every = Counter(dict.fromkeys([w for t in own for w in t.lower().split()], 0))
    for t in own[:2]:
        every.update([*t.lower().split(), b""])
    assert words == every


def test_the_order_of_words_counts(spark):
    rng = random.Random(8)
    follows = {f"w{i}": [f"w{rng.randrange(40)}" for _ in range(2)] for i in range(40)}

    def prose():
        words = ["w0"]
        while len(words) < 120:
            words.append(rng.choice(follows[words[-1]]))
        return words

    held = [i for i in range(3000, 3400) if zlib.crc32(str(i).encode()) % 7 == 2][:20]
    learnt = [(i, " ".join(prose())) for i in range(300)]
    plain = [prose() for _ in held]
    rows = [(i, " ".join(t)) for i, t in zip(held, plain)]
    mixed = [(i, " ".join(rng.sample(t, len(t)))) for i, t in zip(held, plain)]
    scores = []
    for own in (rows, mixed):
        frame = lm_scoring.scored(spark.createDataFrame(learnt + own, "doc_id long, text string"))
        found = [r for r in frame.collect() if r.doc_id in held]
        scores.append([sum(r[k] for r in found) for k in ("score", "base_score")])
    (ordered, base), (shuffled, same) = scores
    assert base == pytest.approx(same) and shuffled < ordered and ordered > base


def test_misspelled_terms_match():
    terms = [toxicity.Term("idiot", False, 3.0), toxicity.Term("worthless", False, 2.0), toxicity.Term("lowei", True, 1.0)]
    match = toxicity.Automaton(terms).match
    assert match("idiot") == (3.0, 0) and match("idi0t") == (3.0, 1) and match("idiott") == (3.0, 1)
    assert match("wrthles") == (2.0, 2) and match("loweischaft") == (1.0, 0)
    assert match("loeischaft") is None and match("harmless") is None and match("") is None
    plain, quoted = (toxicity.Matcher(terms).sums(t) for t in ("you idiot", 'they said "idiot" to us'))
    assert plain[0] > 0 and quoted[0] == 0 and quoted[2] > 0


def test_a_stem_keeps_its_words_automata():
    terms = [toxicity.Term("idiot", False, 3.0), toxicity.Term("idiot", True, 1.0), toxicity.Term("idiots", False, 2.0)]
    match = toxicity.Automaton(terms).match
    assert match("idiot") == (3.0, 0) and match("idiots") == (2.0, 0) and match("idiotic") == (1.0, 0)
    assert match("idi0t") == (3.0, 1) and match("iidiot") == (3.0, 1) and match("idot") == (3.0, 1)
    match = toxicity.Automaton([toxicity.Term("wretch", True, 1.0), toxicity.Term("scum", False, 2.0)]).match
    assert match("wretchedly") == (1.0, 0) and match("wr3tchedly") == (1.0, 1) and match("w3tchedly") is None
    assert match("scvm") == (2.0, 1) and match("sm") is None
    assert toxicity.Matcher([toxicity.Term("scum", False, 2.0)]).sums("a scvm b")[:6] == (0, 0, 0, 0, 0, 2.0)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
    return row[-1]


def test_automaton_next_to_edit_distances(monkeypatch):
    rng = random.Random(3)
    terms = [toxicity.Term("".join(rng.choices("abc", k=rng.randint(3, 11))), False, 1.0 + i) for i in range(12)]
    automaton = toxicity.Automaton(terms)
    texts = []
    for _ in range(1500):
        word = list(rng.choice(terms).text)
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(word) + 1)
            word[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "b", "d"])
            word = word or ["a"]
        texts.append("".join(word))
    for word in texts:
        near = [(edits(word, t.text), t) for t in terms]
        near = [(n, t) for n, t in near if n <= t.edits]
        found = automaton.match(word)
        assert (found is None) == (not near), word
        if found:
            assert found[1] <= max(n for n, _ in near) and found in {(t.weight, n) for n, t in near}
    # an automaton that is started anew for every few words matches the same
    plain = toxicity.Matcher(terms).sums(" ".join(texts))
    monkeypatch.setattr(toxicity, "STATES", 5)
    matcher = toxicity.Matcher(terms)
    first = matcher.automaton
    assert matcher.sums(" ".join(texts)) == plain and matcher.automaton is not first


def test_long_terms_and_words_are_matched_whole():
    long = "abcdefghij" * 7
    match = toxicity.Matcher([toxicity.Term(long, False, 2.0), toxicity.Term(long[:64], False, 1.0)]).sums
    assert match(long)[:2] == (2.0, 0.0) and match(long[:64])[:2] == (1.0, 0.0)
    assert match(long[:68])[:2] == (0.0, 2.0)  # two letters short of the longer term
    assert match(long[:64] + "z" * 8)[6] == 0 and match("x" * 200_000)[6] == 0


def test_a_rare_language_and_a_late_part_of_long_words_are_learnt(spark):
    rng = random.Random(5)

    def prose(letters, n):
        return " ".join("".join(rng.choices(letters, k=6)) for _ in range(n))

    rows = [(i, prose("abcdefg", 12), "common") for i in range(600)]
    rows += [(1000 + i, prose("uvwxyz", 12), "rare") for i in range(6)]
    # words of one span that all languages share, followed by letters of one language
    rows += [(2000 + i, "m" * language.SPAN + "".join(rng.choices("\u4e00\u4e01\u4e02", k=40)), "late") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    network = language.learn(docs, sample_docs=20)
    assert set(network.languages) == {"common", "rare", "late"}
    fresh = [(1, prose("uvwxyz", 30), None), (2, prose("abcdefg", 30), None), (3, "m" * 24 + "\u4e00\u4e02" * 30, None)]
    found = language.identified(spark.createDataFrame(fresh, docs.schema), network).collect()
    assert {r.doc_id: r.lang_pred for r in found} == {1: "rare", 2: "common", 3: "late"}


def test_words_of_a_family_stay_in_the_lexicon(spark):
    rows = [(1, f"idiot idiots scum w{i}") for i in range(20)] + [(0, f"fine words v{i}") for i in range(20)]
    sample = spark.createDataFrame(rows, "toxic long, text string")
    terms = toxicity._lexicon(sample, 4, 0.97, 100)
    assert {t.text for t in terms if not t.stem} == {"idiot", "idiots", "scum"}
    assert [t.text for t in terms if t.stem] == ["idio"]
    match = toxicity.Automaton(terms).match
    assert all(match(w) for w in ("idi0t", "iidiot", "idot", "scvm", "idiotic"))


def test_toxic_documents_go(spark):
    rng = random.Random(3)
    words = ["".join(rng.choices("aeioulmnrst", k=5)) for _ in range(80)]
    rows = []
    for i in range(400):
        own = rng.choices(words, k=30)
        if i % 4 == 0:
            own[3:3] = ["zzidiot", "qqmoron"] * 2
        rows.append((i, " ".join(own), int(i % 4 == 0)))
    docs = spark.createDataFrame([(i, t, "s") for i, t, _ in rows] + [(None, None, "s"), (999, "", None)],
                                 "doc_id long, text string, source string")
    labels = spark.createDataFrame([(i, x) for i, _, x in rows], "doc_id long, toxic int")
    found = toxicity.scored(docs, toxicity.learn(docs, labels)).collect()
    truth = {i: x for i, _, x in rows} | {None: 0, 999: 0}
    assert all(r.predicted == truth[r.doc_id] for r in found) and len(found) == 402
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 302


def test_languages(spark):
    rng = random.Random(6)
    sounds = {"aa": "abcde", "bb": "uvwxy"}
    rows = [
        (i, " ".join("".join(rng.choices(sounds[l], k=4)) for _ in range(20)), l)
        for i, l in enumerate(["aa", "bb"] * 60)
    ]
    docs = spark.createDataFrame([*rows, (500, "12 !", "aa"), (501, None, None)], "doc_id long, text string, lang string")
    found = by_id(language.identified(docs, language.learn(docs)))
    assert all(found[i].lang_pred == l and 0.5 < found[i].score <= 1 for i, _, l in rows)
    assert found[500].lang_pred == found[501].lang_pred == "und"


def test_empty_tables(empty, labels, spark):
    no_labels = labels.limit(0)
    frames = [
        jaccard.near_copies(empty),
        toxicity.scored(empty, toxicity.learn(empty, no_labels)),
        lm_scoring.scored(empty),
        language.identified(empty, language.learn(empty)),
        packing.pack(empty, BPE),
        tokens.token_counts(empty, PIECES),
        suffix_dedup.deduplicated(empty),
        mixing.mix(empty),
        exact_dedup.exact_groups(empty),
        quality_rules.judged(empty, quality_rules.learn_from(empty, no_labels, Work(spark, "none"))),
    ]
    assert [f.count() for f in frames] == [0] * 10


def test_texts_are_joined_once_for_hot_and_other_regions(spark, monkeypatch):
    joins, contexts = [], suffix_dedup._contexts
    monkeypatch.setattr(suffix_dedup, "_contexts", lambda *args: joins.append(args) or contexts(*args))
    rng = random.Random(9)
    passage, other = ("".join(rng.choices("abcdefgh", k=150)) for _ in range(2))
    own = ["".join(rng.choices("ijklmnop", k=120)) for _ in range(60)]
    rows = [(i, (x + (passage if i < 55 else other) + x[::-1]).encode()) for i, x in enumerate(own)]
    docs = spark.createDataFrame(rows, "id long, text binary").repartition(4)
    spans = suffix_dedup.repeated_spans(docs, hot=20).collect()
    covered = {(r.id, x) for r in spans for x in range(r.start, r.end)}
    assert {(i, x) for i in range(60) if i not in (0, 55) for x in range(120, 270)} <= covered
    assert not {i for i, _ in covered} & {0, 55} and len(joins) == 1
