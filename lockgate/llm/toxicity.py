"""Toxicity by fuzzy lexicon matches in context.

A lexicon of words and stems is learned from labelled rows; its trie is intersected with
Levenshtein automata, so misspelled terms are caught too. A stem stands beside the words it
was found in, which keep their own automata; stems of six letters take an edit too. The
product of both is a finite automaton whose states are built when they are first met, so
almost every word is rejected after a few characters. Each match is weighed by its context
window: whether it stands in quotation marks or beside a word of reporting, or beside words
of address. Misspellings of four-letter words are often other words, so they have a sum of
their own. A logistic model over these sums gives the score.

Lexicon and model are fitted on a bounded sample: ``sample_toxic`` and ``sample_clean``
labelled rows of smallest id hash (defaults 6,000 and 12,000), half of it for the lexicon
and half for the model; of entries that pass ``purity`` the ``most_terms`` (5,000) of highest
odds are taken. Words are matched whole, however long. Null and empty texts have no match and get the model's score for
none. Without labels of both kinds every score is 0. Labels that are null are left out;
of several labels for an id the highest counts. Repeated rows are scored each. An empty
table gives no rows. Other columns of the caller are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lockgate.llm.common import Work, remainder

WORD = re.compile(r"[^\W_]+")
WINDOW = 6
MEMORY = 400_000
#: An automaton is started anew, between two words, beyond so many moves or states.
MOVES, STATES = 2_000_000, 200_000
#: Fixed words that mark a report of someone else's words, and words that address a reader.
REPORTING = frozenset("said says wrote writes quoted quote quotes called cited reported "
                      "dijo llamó schrieb sagte nannte zitierte écrit dit appelé cité".split())
ADDRESS = frozenset("you your youre u du dich dein ihr tu te toi ton vous tú usted eres".split())
QUOTES = re.compile('["“”«»„]')
SUMS = ("exact", "fuzzy", "quoted", "address", "density", "short")
SHORT = 4


@dataclass(frozen=True)
class Term:
    """A lexicon entry; a stem stands for every word that begins with it."""

    text: str
    stem: bool
    weight: float

    @property
    def edits(self) -> int:
        """Misspellings allowed: none in short stems and in words below ``SHORT`` letters."""
        if self.stem:
            return int(len(self.text) >= 6)
        return 0 if len(self.text) < SHORT else 1 if len(self.text) < 9 else 2


def _closest(match: tuple[float, int, bool]) -> tuple[int, bool, float]:
    weight, edits, short = match
    return edits, short, -weight


class Automaton:
    """The lexicon trie times the Levenshtein automata of its terms, built as it is used."""

    def __init__(self, terms: list[Term]) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[Term | None] = [None]  # words
        self.stems: list[Term | None] = [None]
        self.most = [0]  # edits that any term below may still use
        for term in terms:
            node = 0
            self.most[0] = max(self.most[0], term.edits)
            for c in term.text:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append(None)
                    self.stems.append(None)
                    self.most.append(0)
                node = self.children[node][c]
                self.most[node] = max(self.most[node], term.edits)
            ends = self.stems if term.stem else self.ends
            if ends[node] is None or ends[node].weight < term.weight:
                ends[node] = term
        self.states: list[tuple[tuple[int, int], ...]] = []
        self.names: dict[tuple, int] = {}
        # matches: weight, edits and whether a short word is misspelled
        self.found: list[tuple[float, int, bool] | None] = []  # at the end of a word
        self.sure: list[tuple[float, int, bool] | None] = []  # a stem that was passed
        self.moves: dict[tuple[int, str], int] = {}
        self.start = self._state({0: 0}, None)

    def _state(self, nodes: dict[int, int], stem: tuple[float, int, bool] | None) -> int:
        """The number of the state that holds ``nodes`` (trie node: edits) after deletions."""
        todo = list(nodes.items())
        while todo:
            node, edits = todo.pop()
            for child in self.children[node].values():
                if edits < self.most[child] and nodes.get(child, 9) > edits + 1:
                    nodes[child] = edits + 1
                    todo.append((child, edits + 1))
        passed = [stem] if stem else []
        for node, edits in nodes.items():
            end = self.stems[node]
            if end and edits <= end.edits:
                passed.append((end.weight, edits, False))
        stem = min(passed, key=_closest, default=None)
        key = (tuple(sorted(nodes.items())), stem)
        if key not in self.names:
            self.names[key] = len(self.states)
            self.states.append(key[0])
            self.sure.append(stem)
            ends = [(self.ends[n], e) for n, e in nodes.items() if self.ends[n]]
            whole = [(t.weight, e, e > 0 and len(t.text) <= SHORT) for t, e in ends if e <= t.edits]
            self.found.append(min([*whole, *([stem] if stem else [])], key=_closest, default=None))
        return self.names[key]

    def step(self, state: int, char: str) -> int:
        """The state after one more character; -1 when no term can match any more."""
        move = self.moves.get((state, char))
        if move is None:
            after: dict[int, int] = {}
            for node, edits in self.states[state]:
                for c, child in self.children[node].items():
                    cost = edits + (c != char)
                    if cost <= self.most[child] and after.get(child, 9) > cost:
                        after[child] = cost
                if edits < self.most[node] and after.get(node, 9) > edits + 1:
                    after[node] = edits + 1
            stem = self.sure[state]
            move = self._state(after, stem) if after or stem else -1
            self.moves[state, char] = move
        return move

    @property
    def large(self) -> bool:
        """Whether it has grown so far that a new one should take its place."""
        return len(self.moves) > MOVES or len(self.states) > STATES

    def match(self, word: str) -> tuple[float, int] | None:
        """(weight, edits) of the closest term, or None."""
        found = self.closest(word)
        return found and found[:2]

    def closest(self, word: str) -> tuple[float, int, bool] | None:
        """(weight, edits, whether a short word is misspelled) of the closest term, or None."""
        state = self.start
        moves = self.moves
        for c in word:
            move = moves.get((state, c))
            state = self.step(state, c) if move is None else move
            if state < 0:
                return None
            if self.sure[state] and not self.states[state]:
                break
        return self.found[state]


class Matcher:
    """Sums over the matches of whole texts, with a bounded memory of words."""

    def __init__(self, terms: list[Term]) -> None:
        self.terms = terms
        self.automaton = Automaton(terms)
        self.known: dict[str, tuple[float, int, bool] | None] = {}

    def sums(self, text: str) -> tuple[float, float, float, float, float, float, int]:
        text = text.lower()
        words = WORD.findall(text)
        known = self.known
        if len(known) > MEMORY:
            known.clear()
        hits = set()
        for w in set(words):
            if w not in known:
                if self.automaton.large:
                    self.automaton = Automaton(self.terms)
                known[w] = self.automaton.closest(w)
            if known[w] is not None:
                hits.add(w)
        if not hits:
            return 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0
        exact = fuzzy = quoted = address = short = 0.0
        n = 0
        spans = [(m.start(), m.end()) for m in WORD.finditer(text)]
        for i, w in enumerate(words):
            if w not in hits:
                continue
            n += 1
            weight, edits, little = known[w]
            near = words[max(0, i - WINDOW) : i] + words[i + 1 : i + 1 + WINDOW]
            a, b = spans[max(0, i - WINDOW)][0], spans[min(len(spans) - 1, i + WINDOW)][1]
            left, right = text[a : spans[i][0]], text[spans[i][1] : b]
            reported = bool(QUOTES.search(left) and QUOTES.search(right))
            if reported or not REPORTING.isdisjoint(near):
                quoted += weight
            elif little:
                short += weight
            elif edits:
                fuzzy += weight
            else:
                exact += weight
            if not little and not ADDRESS.isdisjoint(near):
                address += weight
        total = exact + fuzzy
        return exact, fuzzy, quoted, address, 100 * total / (len(words) + 20), short, n


@dataclass(frozen=True)
class ToxicModel:
    terms: tuple[Term, ...]
    weights: tuple[float, ...]  # bias, then one for each of SUMS

    def score(self, sums: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.zeros(len(sums))
        return 1 / (1 + np.exp(-np.clip(_scaled(sums) @ np.array(self.weights), -30, 30)))


def _scaled(sums: np.ndarray) -> np.ndarray:
    return np.hstack([np.ones((len(sums), 1)), np.log1p(sums)])


def _fit(sums: np.ndarray, toxic: np.ndarray, rounds: int = 30, ridge: float = 0.05) -> tuple[float, ...]:
    """Logistic regression by Newton steps."""
    x = _scaled(sums)
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(w))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - toxic) + penalty @ w
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty + 1e-6 * np.eye(len(w)), grad)
    return tuple(map(float, w))


def _lexicon(sample: DataFrame, min_docs: int, purity: float, most: int) -> list[Term]:
    """Words and stems that labelled toxic texts hold far more often than clean ones."""
    sizes = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return []
    tokens = F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{Nd}]+"), F.lit(0))
    per_doc = sample.select("toxic", F.array_distinct(tokens).alias("w"))
    stems = [
        F.transform("w", lambda x: F.concat(F.substring(x, 1, 4), F.lit("*"))),
        F.transform("w", lambda x: F.concat(F.substring(x, 1, 5), F.lit("*"))),
        F.transform("w", lambda x: F.concat(F.substring(x, 1, 6), F.lit("*"))),
    ]
    entries = F.array_distinct(F.concat("w", *stems))
    counts = (
        per_doc.select("toxic", F.explode(entries).alias("term"))
        .groupBy("term")
        .agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    )
    scale = sizes[1] / sizes[0]
    share = F.col("bad") / (F.col("bad") + F.col("good") * scale)
    odds = F.log((F.col("bad") + 0.5) / (sizes[1] + 1)) - F.log((F.col("good") + 0.5) / (sizes[0] + 1))
    rows = (
        counts.filter((F.col("bad") >= min_docs) & (share >= purity))
        .select("term", odds.alias("odds"))
        .orderBy(F.col("odds").desc(), "term")
        .limit(most)
        .collect()
    )
    found = [Term(r.term.rstrip("*"), r.term.endswith("*"), r.odds) for r in rows]
    words = [t.text for t in found if not t.stem]
    # a stem counts only where it stands for several words, else the word itself is the term
    several = {t.text for t in found if t.stem and sum(w.startswith(t.text) for w in words) != 1}
    heads = {s for s in several if not any(s != t and s.startswith(t) for t in several)}
    return [t for t in found if not t.stem or t.text in heads]


def _sums(rows: DataFrame, terms: tuple[Term, ...], *keep: str) -> DataFrame:
    names = [*SUMS, "n_hits"]

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(list(terms))
        for batch in batches:
            found = [matcher.sums(t) for t in batch.column("text").to_pylist()]
            columns = list(zip(*found, strict=True)) or [()] * len(names)
            arrays = [pa.array(c, pa.float64()) for c in columns[:-1]] + [pa.array(columns[-1], pa.int64())]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), *arrays], [*keep, *names])

    kinds = dict(rows.dtypes)
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), *(f"{s} double" for s in SUMS), "n_hits long"])
    return rows.select(*keep, "text").mapInArrow(match, schema)


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_toxic: int = 6_000,
    sample_clean: int = 12_000,
    min_docs: int = 4,
    purity: float = 0.97,
    most_terms: int = 5_000,
) -> ToxicModel:
    """Fit lexicon and model on labelled rows whose id remainder by 3 is not 1."""
    work = Work(docs.sparkSession, "toxicity")
    known = (
        labels.filter("doc_id is not null and toxic in (0, 1)")
        .filter(remainder("doc_id", 3) != 1)
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("long").alias("toxic"))
    )
    order = [F.xxhash64("doc_id", F.lit(11)), F.col("doc_id")]
    picked = known.filter("toxic = 1").orderBy(*order).limit(sample_toxic).unionByName(
        known.filter("toxic = 0").orderBy(*order).limit(sample_clean)
    )
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # at most sample_toxic + sample_clean pairs of numbers
    sample = work.write(rows.join(F.broadcast(picked), "doc_id"), "sample")
    half = F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(2))
    terms = tuple(_lexicon(sample.filter(half == 0), min_docs, purity, most_terms))
    found = np.array(
        [tuple(r) for r in _sums(sample.filter(half == 1), terms, "toxic").drop("n_hits").collect()], float
    ).reshape(-1, 1 + len(SUMS))
    toxic = found[:, 0]
    work.drop("sample")
    if not terms or not 0 < toxic.sum() < len(toxic):
        return ToxicModel(terms, ())
    return ToxicModel(terms, _fit(found[:, 1:], toxic))


def scored(
    docs: DataFrame,
    model: ToxicModel,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.7,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, held_out, score, predicted, n_hits and the columns in ``keep``."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *keep
    )
    sums = _sums(rows, model.terms, "doc_id", *keep)
    if model.weights:
        line = F.lit(model.weights[0])
        for name, w in zip(SUMS, model.weights[1:], strict=True):
            line = line + F.log1p(name) * w
        score = 1 / (1 + F.exp(-line))
    else:
        score = F.lit(0.0)
    return (
        sums.withColumn("held_out", remainder("doc_id", 3) == 1)
        .withColumn("score", score)
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
        .select("doc_id", "held_out", "score", "predicted", "n_hits", *keep)
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that the model rejects."""
    model = learn(docs, labels)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row")
    held = docs.select(F.col("doc_id").alias("__id"), F.col("text").alias("__text"), row)
    return scored(held, model, "__id", "__text", keep=("__row",)).filter("predicted = 0").select("__row.*")
