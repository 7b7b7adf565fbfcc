"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the UTF-8 bytes of a word (ASCII letters in lower case) from both ends
and labels every position; states start anew at white space and after ``SPAN`` bytes. A
document's probabilities are the pooled log probabilities of all its positions. It is
written in numpy and trained by backpropagation through time with Adam.

Training uses a bounded sample of each language: the words of ``sample_docs`` documents
(default 1,000) of smallest id hash, cut into spans as in labelling, and at most
``sample_words`` distinct spans of them (20,000). A language is learnt however rare it is
beside the others. Labelling covers every byte of every text; a word is labelled once and remembered, in a
memory of ``MEMORY`` words for each Python worker.

Null texts and texts without a letter are ``und`` with score 0; so is every text when no
labelled row exists. Ties go to the first language in code point order. Repeated rows are
labelled each; of an id with several languages each counts for its own. Very long texts are
read whole. An empty table gives no rows. Other columns of the caller are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lockgate.llm.common import Work, lowered, remainder, words
from lockgate.llm.tokens import runs

SPAN = 24
DRAWS = 1 << 31
MEMORY = 300_000


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


class Gru:
    """One direction: three gates, bytes enter through rows of a table."""

    def __init__(self, rng: np.random.Generator, hidden: int) -> None:
        self.h = hidden
        self.table = (rng.standard_normal((256, 3 * hidden)) * 0.3).astype(np.float32)
        self.u = (rng.standard_normal((hidden, 2 * hidden)) / hidden**0.5).astype(np.float32)
        self.v = (rng.standard_normal((hidden, hidden)) / hidden**0.5).astype(np.float32)

    def forward(self, x: np.ndarray, tape: list | None = None) -> np.ndarray:
        """States after each of the bytes ``x`` (time, rows); ``tape`` keeps what BPTT needs."""
        k = self.h
        state = np.zeros((x.shape[1], k), np.float32)
        out = np.empty((len(x), x.shape[1], k), np.float32)
        for t, at in enumerate(x):
            e = self.table[at]
            gates = _sigmoid(e[:, : 2 * k] + state @ self.u)
            z, r = gates[:, :k], gates[:, k:]
            c = np.tanh(e[:, 2 * k :] + (r * state) @ self.v)
            if tape is not None:
                tape.append((state, z, r, c))
            state = state + z * (c - state)
            out[t] = state
        return out

    def backward(self, x: np.ndarray, tape: list, d_out: np.ndarray) -> list[np.ndarray]:
        k = self.h
        d_table, d_u, d_v = map(np.zeros_like, (self.table, self.u, self.v))
        d_state = np.zeros_like(d_out[0])
        for t in range(len(x) - 1, -1, -1):
            before, z, r, c = tape[t]
            d = d_out[t] + d_state
            d_c = d * z * (1 - c * c)
            d_rs = d_c @ self.v.T
            d_v += (r * before).T @ d_c
            d_gates = np.hstack([d * (c - before) * z * (1 - z), d_rs * before * r * (1 - r)])
            d_u += before.T @ d_gates
            np.add.at(d_table, x[t], np.hstack([d_gates, d_c]))
            d_state = d * (1 - z) + d_rs * r + d_gates @ self.u.T
        return [d_table, d_u, d_v]


class Network:
    def __init__(self, languages: list[str], hidden: int = 12, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.ways = [Gru(rng, hidden), Gru(rng, hidden)]
        self.w = (rng.standard_normal((2 * hidden, len(languages))) * 0.1).astype(np.float32)
        self.b = np.zeros(len(languages), np.float32)

    def _logs(self, ahead: np.ndarray, back: np.ndarray) -> np.ndarray:
        """Log probabilities of each position, (time, rows, languages)."""
        logits = np.concatenate([ahead, back], axis=2) @ self.w + self.b
        logits -= logits.max(axis=2, keepdims=True)
        return logits - np.log(np.exp(logits).sum(axis=2, keepdims=True))

    def label(self, x: np.ndarray) -> np.ndarray:
        return self._logs(self.ways[0].forward(x), self.ways[1].forward(x[::-1])[::-1])

    def step(self, x: np.ndarray, y: np.ndarray, adam: Adam) -> float:
        """One step of training on rows of equal length; the mean loss of a position."""
        tapes: tuple[list, list] = ([], [])
        ahead = self.ways[0].forward(x, tapes[0])
        back = self.ways[1].forward(x[::-1], tapes[1])[::-1]
        logs = self._logs(ahead, back)
        d = np.exp(logs)
        d[:, np.arange(len(y)), y] -= 1
        d /= d.shape[0] * d.shape[1]
        both = np.concatenate([ahead, back], axis=2)
        d_both = d @ self.w.T
        k = self.ways[0].h
        grads = [
            *self.ways[0].backward(x, tapes[0], d_both[:, :, :k]),
            *self.ways[1].backward(x[::-1], tapes[1], d_both[::-1, :, k:]),
            np.tensordot(both, d, axes=([0, 1], [0, 1])),
            d.sum(axis=(0, 1)),
        ]
        adam.update(self.parameters(), grads)
        return float(-logs[:, np.arange(len(y)), y].mean())

    def parameters(self) -> list[np.ndarray]:
        return [*(p for g in self.ways for p in (g.table, g.u, g.v)), self.w, self.b]


class Adam:
    def __init__(self, parameters: list[np.ndarray], rate: float) -> None:
        self.m = [np.zeros_like(p) for p in parameters]
        self.v = [np.zeros_like(p) for p in parameters]
        self.rate, self.t = rate, 0

    def update(self, parameters: list[np.ndarray], grads: list[np.ndarray]) -> None:
        self.t += 1
        rate = self.rate * (1 - 0.999**self.t) ** 0.5 / (1 - 0.9**self.t)
        for p, g, m, v in zip(parameters, grads, self.m, self.v, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= (rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)


def train(
    examples: list[tuple[str, bytes, int]], steps: int = 900, rows: int = 192, seed: int = 9
) -> Network:
    """Train on (language, word, count); languages get equal shares of the steps."""
    languages = sorted({e[0] for e in examples})
    network = Network(languages)
    rng = np.random.default_rng(seed)
    # languages share a length's batch by their words' counts, each language scaled to one
    totals = {l: sum(n for m, _, n in examples if m == l) for l in languages}
    by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    for size in range(1, SPAN + 1):
        held = [(w, languages.index(l), n / totals[l]) for l, w, n in examples if len(w) == size]
        if held:
            x = np.frombuffer(b"".join(w for w, _, _ in held), np.uint8).reshape(-1, size)
            by_length[size] = (x, np.array([y for _, y, _ in held]), np.array([p for _, _, p in held]))
    sizes = list(by_length)
    mass = np.array([by_length[s][2].sum() for s in sizes])
    adam = Adam(network.parameters(), 0.01)
    for step in range(steps):
        adam.rate = 0.01 * (1 - step / steps) + 0.0005
        x, y, p = by_length[sizes[rng.choice(len(sizes), p=mass / mass.sum())]]
        pick = rng.choice(len(x), rows, p=p / p.sum())
        network.step(np.ascontiguousarray(x[pick].T), y[pick], adam)
    return network


class Labeller:
    """Word sums of position log probabilities, remembered; documents by pooling them."""

    def __init__(self, network: Network) -> None:
        self.network = network
        self.index: dict[bytes, int] = {}
        self.sums = np.zeros((0, len(network.languages)), np.float32)

    def _learn(self, new: list[bytes]) -> None:
        spans: list[tuple[int, bytes]] = []
        for i, w in enumerate(new):
            spans.extend((i, w[a : a + SPAN]) for a in range(0, len(w), SPAN))
        spans.sort(key=lambda s: len(s[1]))
        sums = np.zeros((len(new), len(self.network.languages)), np.float32)
        at = 0
        while at < len(spans):
            size = len(spans[at][1])
            end = at
            while end < len(spans) and end < at + 4096 and len(spans[end][1]) == size:
                end += 1
            x = np.frombuffer(b"".join(s for _, s in spans[at:end]), np.uint8).reshape(-1, size)
            logs = self.network.label(np.ascontiguousarray(x.T)).sum(axis=0)
            np.add.at(sums, np.array([i for i, _ in spans[at:end]]), logs)
            at = end
        for i, w in enumerate(new, len(self.sums)):
            self.index[w] = i
        self.sums = np.vstack([self.sums, sums])

    def documents(self, texts: list[bytes]) -> np.ndarray:
        """Mean log probabilities over a document's positions, a row for each text."""
        out = np.zeros((len(texts), len(self.network.languages)))
        cut = [t.split() for t in texts]
        if len(self.index) > MEMORY:
            self.index, self.sums = {}, self.sums[:0]
        new = sorted(set().union(*cut) - self.index.keys()) if cut else []
        if new:
            self._learn(new)
        for k, own in enumerate(cut):
            if own:
                at = np.fromiter(map(self.index.__getitem__, own), np.int64, len(own))
                out[k] = self.sums[at].sum(axis=0, dtype=np.float64) / sum(map(len, own))
        return out


def learn(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_docs: int = 1_000,
    sample_words: int = 20_000,
) -> Network | None:
    """Train on documents whose id remainder by 3 is not 1; None without a labelled row."""
    work = Work(docs.sparkSession, "language")
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).filter((remainder("doc_id", 3) != 1) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    draw = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(DRAWS))
    rows = rows.withColumn("draw", draw)
    # far more than enough low draws of each language, however many documents it has:
    # the window below picks the same documents, but sees few of the others
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("held"))
    low = work.write(sizes.select("lang", (4.0 * sample_docs * DRAWS / F.col("held")).alias("below")), "low")
    some = rows.join(low, "lang").filter(F.col("draw") < F.col("below")).select("lang", "doc_id", "draw")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id"))
    picked = some.distinct().select("lang", "doc_id", place.alias("place"))
    # written, so that its size decides how it is joined
    picked = work.write(picked.filter(F.col("place") <= sample_docs).drop("place"), "picked")
    sample = rows.join(picked, ["lang", "doc_id"])
    # digits and signs alone say nothing
    own = (
        sample.select("lang", F.explode(words(lowered(F.col("text")))).alias("word"))
        .filter(F.col("word").rlike(r"\p{L}"))
        .groupBy("lang", "word")
        .agg(F.count("*").alias("n"))
        .select("lang", "n", F.col("word").cast("binary").alias("word"))
    )
    starts = F.sequence(F.lit(0), F.octet_length("word") - 1, F.lit(SPAN))
    spans = own.select("lang", "n", "word", F.explode(starts).alias("start"))
    counts = (
        spans.groupBy("lang", F.expr(f"substring(word, start + 1, {SPAN})").alias("span"))
        .agg(F.sum("n").alias("n"))
        .withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("span", "lang"), "span")))
    )
    held = counts.filter(F.col("place") <= sample_words).orderBy("lang", "place").collect()
    examples = [(r.lang, bytes(r.span), r.n) for r in held]
    work.drop("picked")
    work.drop("low")
    return train(examples) if examples else None


def identified(
    docs: DataFrame, network: Network | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        lowered(F.col(text_col)).cast("binary").alias("text"),
        F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("letters"),
    )
    kind = dict(rows.dtypes)["doc_id"]

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(network) if network else None
        for batch in batches:
            letters = batch.column("letters").to_numpy(zero_copy_only=False)
            names, scores = ["und"] * len(letters), np.zeros(len(letters))
            if labeller and len(letters):
                texts = batch.column("text").to_pylist()
                logs = np.vstack([labeller.documents(texts[run]) for run in runs(texts)])
                p = np.exp(logs - logs.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                best = p.argmax(axis=1)
                scores = np.where(letters, p[np.arange(len(p)), best], 0.0)
                names = [network.languages[b] if ok else "und" for b, ok in zip(best, letters, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores)],
                ["doc_id", "lang_pred", "score"],
            )

    found = rows.mapInArrow(label, f"doc_id {kind}, lang_pred string, score double")
    return found.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")
