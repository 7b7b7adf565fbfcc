"""Benchmark decontamination by winnowing, in built-in functions.

A window is ``window`` consecutive words of a benchmark item, or all of an item that has
fewer. Of the k-gram hashes in every window of a text, the smallest is kept with its place;
k is half a window, so a window holds ``w`` = window - k + 1 of them. A document that
repeats a window has the same hashes in the same order there and keeps the same one, so
every shared span of a window's length is met by a shared fingerprint: nothing is missed.
Where the smallest hash occurs more than once, all of its places are kept on both sides.

Fingerprints are joined by hash alone, and the benchmark's are (hash, place in window), at
most ``w`` for one hash however many items share it. A hit is then extended to the whole
window around it, whose words are compared as text, so hashes decide nothing. A document's
fingerprint carries the few words that such an extension can reach; texts are read once and
never shuffled. Spark broadcasts the benchmark's side where its written size is below the
session's threshold and shuffles both otherwise.

Null text has no words. Texts are fingerprinted whole, whatever their length. Rows that
repeat id and text are rows of their own with equal results; items that repeat an id are one
item, and items without an id share the empty one. An empty benchmark marks nothing and an
empty table gives no rows. Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lockgate.llm.common import Work, lowered

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.regexp_extract_all(lowered(text), F.lit(WORD), F.lit(0))


def _every(start: int, end: Column, body) -> Column:
    """``body(i)`` for i from ``start`` to ``end``; empty where ``end`` is below ``start``."""
    numbers = F.sequence(F.lit(start), F.greatest(end, F.lit(start)))
    return F.when(end >= start, F.transform(numbers, body)).otherwise(F.array())


def _ahead(values: Column, at: Column, count: int) -> list[Column]:
    return [F.get(values, at + i if i else at) for i in range(count)]


def winnowed(rows: DataFrame, span: int, label: str) -> DataFrame:
    """Add ``label``: (m, v, q, s, near) of the fingerprints for windows of ``span`` words.

    ``rows`` has the ``words`` and their ``hashes``. ``v`` is a k-gram's hash, ``q`` its first
    word, ``near`` the words from number ``s`` on that windows through it can hold.
    """
    k = (span + 1) // 2
    w = span - k + 1
    n = F.size("hashes")
    grams, least = f"{label}_grams", f"{label}_least"
    # one step after the other, so that each array is computed once
    rows = rows.withColumn(
        grams, F.when(n >= span, _every(0, n - k, lambda i: F.xxhash64(*_ahead(F.col("hashes"), i, k)))).otherwise(F.array())
    )
    if w > 1:
        # the smallest of each window, and of the windows around a k-gram the largest of these:
        # a k-gram is the smallest of one of its windows where the two agree
        rows = rows.withColumn(
            least, _every(0, n - span, lambda i: F.least(*_ahead(F.col(grams), i, w)))
        )
        kept = F.filter(
            F.sequence(F.lit(0), F.greatest(n - k, F.lit(0))),
            lambda q: F.get(F.col(grams), q) == F.greatest(*_ahead(F.col(least), q - (w - 1), w)),
        )
    else:
        kept = _every(0, n - k, lambda q: q)
    first = lambda q: F.greatest(q - (w - 1), F.lit(0))
    found = F.transform(
        kept,
        lambda q: F.struct(
            F.lit(span).alias("m"),
            F.get(F.col(grams), q).alias("v"),
            q.alias("q"),
            first(q).alias("s"),
            # word by word: a slice would go over the whole text for each fingerprint
            F.array_compact(F.array(*_ahead(F.col("words"), first(q), span + w - 1))).alias("near"),
        ),
    )
    # named twice, the array of k-grams stays a step of its own; else it could be worked out
    # again for each of its elements
    return rows.withColumn(label, F.when(F.size(grams) > 0, found)).drop(grams, least)


def _hashed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("hashes", F.transform("words", lambda word: F.xxhash64(word)))


def windows(benchmark: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """Distinct (m, phrase, item): every window of every item, as text."""
    items = benchmark.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), words(F.col(text_col)).alias("words")
    ).filter(F.size("words") > 0)
    m = F.least(F.size("words"), F.lit(window))
    starts = F.sequence(F.lit(0), F.size("words") - m)
    # words beyond the end of a short item are null, which the text leaves out
    phrases = F.transform(starts, lambda i: F.concat_ws(" ", *_ahead(F.col("words"), i, window)))
    return items.select(m.alias("m"), F.explode(phrases).alias("phrase"), "item").distinct()


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
) -> DataFrame:
    """doc_id, n_words, spans, items for every row of ``docs``.

    ``spans`` lists (first word, number of words) of the windows that occur, in order, and
    ``items`` the ids, as text and sorted, of the items that they belong to. Both are null
    in a clean document.
    """
    work = Work(docs.sparkSession, "decontamination")
    owned = work.write(windows(benchmark, window, item_col, item_text_col), "windows")
    # the driver gets the lengths of windows, at most ``window`` numbers
    spans = sorted(row.m for row in owned.select("m").distinct().collect())
    phrases = owned.select("m", "phrase").distinct().withColumn("words", F.split("phrase", " "))
    marks = None
    for span in spans:
        mine = winnowed(_hashed(phrases.filter(F.col("m") == span)), span, "marks")
        mine = mine.select(F.explode_outer("marks").alias("f"))
        mine = mine.select("f.m", "f.v", F.col("f.q").alias("at")).distinct()
        marks = mine if marks is None else marks.unionByName(mine)
    marks = work.write(marks, "fingerprints") if spans else None

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = _hashed(
        docs.select(
            F.col(id_col).alias("doc_id"),
            # two hashes of id and text name a row in what follows
            F.xxhash64(F.col(id_col), text).alias("k1"),
            F.xxhash64(F.lit(7), F.col(id_col), text).alias("k2"),
            words(F.col(text_col)).alias("words"),
        )
    )
    for span in spans:
        rows = winnowed(rows, span, f"f{span}")
    # An entry that meets nothing stands for the row itself, so that one pass gives both.
    # "outer", because Spark would filter by the size of an array before it is taken apart,
    # and repeat in that filter all that leads to the array.
    itself = F.array(
        F.struct(
            F.lit(0).alias("m"),
            F.col("k1").alias("v"),
            F.lit(-1).alias("q"),
            F.lit(0).alias("s"),
            F.array().cast("array<string>").alias("near"),
        )
    )
    entries = F.concat(itself, *(F.coalesce(F.col(f"f{span}"), F.array()) for span in spans))
    rows = rows.select(
        "doc_id", "k1", "k2", F.size("words").cast("long").alias("n_words"), F.inline_outer(entries)
    )
    if spans:
        rows = rows.join(marks, ["m", "v"], "left").filter((F.col("m") == 0) | F.col("at").isNotNull())
    else:
        rows = rows.withColumn("at", F.lit(None).cast("int"))
    start = F.col("q") - F.col("at")
    phrase = F.when(start >= 0, F.slice("near", F.greatest(start - F.col("s") + 1, F.lit(1)), F.col("m")))
    rows = rows.select(
        "doc_id", "k1", "k2", "n_words", "m", start.alias("p"), F.array_join(phrase, " ").alias("phrase")
    )
    rows = work.write(rows, "hits")

    hits = rows.filter(F.col("m") > 0).select("k1", "k2", "m", "p", "phrase").distinct()
    hits = (
        hits.join(owned, ["m", "phrase"])
        .groupBy("k1", "k2")
        .agg(
            F.sort_array(F.collect_set(F.struct(F.col("p").alias("first"), F.col("m").alias("size")))).alias("spans"),
            F.sort_array(F.collect_set("item")).alias("items"),
        )
    )
    return (
        rows.filter(F.col("m") == 0)
        .select("doc_id", "k1", "k2", "n_words")
        .join(hits, ["k1", "k2"], "left")
        .select("doc_id", "n_words", "spans", "items")
    )


def covered(spans: Column) -> Column:
    """The number of words in any of the spans, which are ordered by their first word."""
    nothing = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("words"))

    def add(state: Column, span: Column) -> Column:
        end = span["first"] + span["size"]
        new = F.greatest(end - F.greatest(state["end"], span["first"]), F.lit(0))
        return F.struct(
            F.greatest(state["end"], end).alias("end"), (state["words"] + new).cast("long").alias("words")
        )

    return F.coalesce(F.aggregate(spans, nothing, add, lambda state: state["words"]), F.lit(0).cast("long"))


def summary(rows: DataFrame) -> DataFrame:
    """:func:`contaminated` with spans counted and items as one digest."""
    items = F.coalesce("items", F.array().cast("array<string>"))
    return rows.select(
        "doc_id",
        "n_words",
        covered(F.col("spans")).alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
    ).withColumn("contaminated", F.col("n_hit") > 0)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **args) -> DataFrame:
    """``docs`` without the documents that hold a window of the benchmark."""
    marked = contaminated(docs, benchmark, id_col, **args).filter("items is not null")
    marked = marked.select(F.col("doc_id").alias("marked")).distinct()
    held = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("held"), F.col(id_col).alias("ident"))
    clean = held.join(marked, F.col("ident").eqNullSafe(F.col("marked")), "left_anti")
    return clean.select("held.*")


#: The query op11 in SQL: every window of a document next to every window of an item.
SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS i
        FROM (SELECT *, least(10, len(w)) AS m FROM b WHERE len(w) > 0))
), sizes AS (
  SELECT DISTINCT m FROM windows
), places AS (
  SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, sizes WHERE len(w) >= m)
), hits AS (
  SELECT doc_id, i, m, item FROM places JOIN windows USING (m, phrase)
), hit_words AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + m)) AS word FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY encode(item)) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""
