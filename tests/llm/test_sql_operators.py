"""Operators that SQL can express: next to their SQL, and next to brute force on awkward rows."""

import hashlib
import random
import re
import zlib

import pytest

from checks.compare import difference, duck
from lockgate.llm import decontamination, fim, manifest, queries

SF = "/root/testdata/sf0.001"
#: Names that the operators use themselves, as columns of the caller.
SCHEMA = """doc_id long, text string, lang string, source string, n_chars long, tree string, pos long,
    digest string, words string, output string, k1 long, held string, marked long"""
ITEMS = "item_id long, text string, words string, item string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def sha_of(parts):
    return sha("".join(parts))


@pytest.mark.parametrize("name", ["op11_decontamination", "op12_manifest", "op13_fill_in_middle"])
def test_query_agrees_with_sql(spark, name):
    assert difference(queries.queries()[name](spark, SF), duck(SF), queries.oracle()[name]) is None


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema).repartition(3)


def rows_of(texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    langs, sources = ("en", None, "dé"), ("b", None, "a", "b", "ä")
    return [
        (i, t, langs[at % 3], sources[at % 5], None if at % 4 == 0 else at, "x", 1, "y", "z", "o", 3, "h", 4)
        for at, (i, t) in enumerate(zip(ids, texts))
    ]


def awkward():
    rng = random.Random(8)
    prose = [" ".join(rng.choices(["Alpha", "beta7", "été", "x"], k=rng.randint(1, 90))) for _ in range(60)]
    odd = ["", None, " ", "a", "\n", "a\nb\n\nc", "日本語 text 😀😀 <", "holds <P> itself", "<S>", "x<M>", "<<P", "S>",
           "word " * 30_000, "é" * 40_000, "Zz" * 30_000, *(f"line {i}\nline\n" for i in range(9)), *[prose[0]] * 4]
    return prose + odd


# fill-in-middle


def expected_fim(ident, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    h = [int(sha(f"1:{'' if ident is None else ident}")[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (ident, n, "plain", None, None, sha(text), sha(text))
    if h[3] % 100 < 20:
        return (ident, n, "spm", len(p), len(m), sha(f"<S>{s}<P>{p}<M>{m}"), sha(text))
    return (ident, n, "psm", len(p), len(m), sha(f"<P>{p}<S>{s}<M>{m}"), sha(text))


def test_fill_in_middle_by_brute_force(spark):
    texts = awkward()
    ids = [*range(len(texts) - 6), 3, 3, 4, 4, None, None]
    rows = rows_of(texts, ids) + rows_of(texts[:20], range(1000, 1020))
    found = fim.digests(fim.transformed(table(spark, rows))).collect()
    expected = [expected_fim(r[0], r[1]) for r in rows]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))
    assert {e[2] for e in expected} == {"plain", "psm", "spm"}


def test_fill_in_middle_gives_texts(spark):
    docs = table(spark, rows_of(["one two", "three four five", "six"] * 5))
    for row in fim.transformed(docs, rate=100, suffix_first=0).collect():
        prefix, suffix, middle = re.fullmatch("<P>(.*)<S>(.*)<M>(.*)", row.output).groups()
        assert prefix + middle + suffix == row.text
        assert (row.prefix_chars, row.middle_chars) == (len(prefix), len(middle))


# manifest


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes):
    """Root, and for every leaf its siblings level by level, by plain recursion."""
    paths, owner = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        for at, held in enumerate(owner):
            first = at - at % 3
            for i in held:
                paths[i].append(("".join(nodes[first:at]), "".join(nodes[at + 1 : first + 3])))
        owner = [sum(owner[i : i + 3], []) for i in range(0, len(owner), 3)]
        nodes = [sha_of(nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], paths


def expected_proofs(rows):
    def leaf(row, text):
        return sha_of(field(x) for x in (row[0], row[3], row[2], row[4], text))

    def null_first(value):
        return (value is not None, value.encode() if isinstance(value, str) else value or 0)

    sources = sorted({r[3] for r in rows}, key=null_first)
    trees = {}
    for source in sources:
        mine = sorted((r for r in rows if r[3] == source), key=lambda r: (null_first(r[0]), leaf(r, r[1])))
        trees[source] = (mine, *tree([leaf(r, r[1]) for r in mine]))
    root, above = tree([trees[s][1] for s in sources])
    out = []
    for source, beyond in zip(sources, above):
        mine, subroot, paths = trees[source]
        for row, path in zip(mine, paths):
            even = zlib.crc32(("" if row[0] is None else str(row[0])).encode()) % 2 == 0
            text = row[1].replace("\n", "") if even and row[1] is not None else row[1]
            node = leaf(row, text)
            for left, right in path + beyond:
                node = sha(left + node + right)
            proof = sha_of(x + y for x, y in path + beyond)
            out.append((row[0], leaf(row, row[1]), subroot, root, proof, node, node == root))
    return out


@pytest.mark.parametrize("depth", [1, 2, 6])
def test_manifest_by_brute_force(spark, depth):
    texts = awkward()
    ids = [*range(len(texts) - 6), 3, 3, 4, 4, None, None]
    rows = rows_of(texts, ids)
    rows += [rows[5]] * 25  # repeated rows
    found = manifest.proofs(table(spark, rows), depth=depth).collect()
    expected = expected_proofs(rows)
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))
    assert {e[-1] for e in expected} == {True, False}


@pytest.mark.parametrize("rows", [1, 2, 4])
def test_manifest_of_few_rows(spark, rows):
    docs = rows_of([f"text {i}\n" for i in range(rows)])
    found = manifest.proofs(table(spark, docs)).collect()
    assert sorted(map(tuple, found)) == sorted(expected_proofs(docs))


# decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def expected_hits(docs, items):
    windows = {}
    for ident, text, *_ in items:
        w = words(text)
        m = min(10, len(w))
        for i in range(len(w) - m + 1) if w else ():
            windows.setdefault(tuple(w[i : i + m]), set()).add("" if ident is None else str(ident))
    out = []
    for ident, text, *_ in docs:
        w, hit, found = words(text), set(), set()
        for m in {len(p) for p in windows}:
            for i in range(len(w) - m + 1):
                owners = windows.get(tuple(w[i : i + m]))
                if owners:
                    hit.update(range(i, i + m))
                    found |= owners
        out.append((ident, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def benchmark_rows():
    rng = random.Random(3)
    # few different words: many equal hashes within a window
    items = [" ".join(rng.choices("abcd", k=rng.randint(10, 40))) for _ in range(12)]
    items += ["Été à la mer", "one", "one two", "same same same", "a " * 25, "a b " * 11, "", None, "... !", "ÀB c9"]
    items += ["The quick brown fox jumps over the lazy dog and runs away home"] * 2
    ids = [*range(len(items) - 3), None, None, 5]
    return [(i, t, "w", "i") for i, t in zip(ids, items)]


def test_decontamination_by_brute_force(spark):
    items = benchmark_rows()
    rng = random.Random(6)
    texts = [t for _, t, *_ in items] + ["x " * 5 + (t or "") + " y" for _, t, *_ in items]
    texts += [" ".join(rng.choices("abcd", k=rng.randint(1, 400))) for _ in range(60)]
    texts += ["a " * 3000, "THE Quick--brown fox, jumps over the lazy dog and", "quick brown fox jumps over the lazy dog"]
    texts += awkward()
    ids = [*range(len(texts) - 6), 3, 3, 4, 4, None, None]
    docs = rows_of(texts, ids)
    docs += [docs[0], docs[0], docs[30]]
    frame, bench = table(spark, docs), table(spark, items, ITEMS)
    found = decontamination.summary(decontamination.contaminated(frame, bench)).collect()
    expected = expected_hits(docs, items)
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))
    kept = decontamination.drop_contaminated(frame, bench)
    dirty = {e[0] for e in expected if e[-1]}
    assert kept.columns == frame.columns
    assert sorted(map(str, kept.collect())) == sorted(
        map(str, (r for r in frame.collect() if r.doc_id not in dirty))
    )


def test_decontamination_without_broadcast(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    items = benchmark_rows()[:12]
    docs = rows_of([f"before {t} after" for _, t, *_ in items] + ["nothing here"])
    found = decontamination.contaminated(table(spark, docs), table(spark, items, ITEMS))
    assert sorted(map(tuple, decontamination.summary(found).collect())) == sorted(expected_hits(docs, items))


def test_spans_and_items_are_real(spark):
    items = [(7, " ".join(f"w{i}" for i in range(14)), "w", "i")]
    docs = rows_of(["w1 " + items[0][1] + " w2"])
    row = decontamination.contaminated(table(spark, docs), table(spark, items, ITEMS)).first()
    assert [tuple(s) for s in row.spans] == [(i, 10) for i in range(1, 6)]
    assert row["items"] == ["7"]


def test_empty_tables(spark):
    none, items = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], ITEMS)
    some = table(spark, rows_of(["a b", None, ""]))
    assert fim.digests(fim.transformed(none)).count() == 0
    assert manifest.proofs(none).count() == 0
    assert decontamination.contaminated(none, table(spark, benchmark_rows(), ITEMS)).count() == 0
    rows = decontamination.summary(decontamination.contaminated(some, items)).collect()
    assert sorted((r.n_words, r.n_hit, r.n_items, r.contaminated) for r in rows) == [
        (0, 0, 0, False), (0, 0, 0, False), (2, 0, 0, False)
    ]
