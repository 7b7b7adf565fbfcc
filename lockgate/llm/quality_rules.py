"""Quality rules as a learned decision list, without Python on the data path.

Statistics of a text come from built-in functions. Sequential covering grows one rule
after another from labelled rows: a rule is a conjunction of thresholds on statistics,
each step adds the threshold with the best gain of information, and a pruning share of
the rows then removes last conditions that don't help. Covered rows leave, and the
next rule is grown. The list is emitted as one ordered ``CASE WHEN`` expression.

Only counts reach the driver. The labelled rows are a bounded sample: the
``sample_rows`` of smallest id hash (default 50,000). Null text has no words; null labels
are left out. Without usable labels the list is empty and the base rule decides alone.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lockgate.llm.common import SPACE, WORD, Work, let, words

SYMBOLS = "#*$%&|<>"
FEATURES = ("symbol_share", "dup_line_share", "repeat_share", "word_length", "n_words", "distinct_share")


def _repeated(windows: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more, from window hashes."""

    def covered(at: Column) -> Column:  # sorted places of such windows
        step = F.zip_with(
            F.slice(at, 2, F.greatest(F.size(at) - 1, F.lit(0))),
            F.slice(at, 1, F.greatest(F.size(at) - 1, F.lit(0))),
            lambda b, a: F.least(b - a, F.lit(3)),
        )
        total = F.aggregate(step, F.lit(0), lambda acc, x: acc + x)
        return F.when(F.size(at) == 0, 0).otherwise(total + 3)

    def places(sorted_: Column) -> Column:
        n = F.size(sorted_)
        last = F.concat(F.slice(sorted_, 2, n - 1), F.array(F.element_at(sorted_, 1)))
        first = F.concat(F.array(F.element_at(sorted_, -1)), F.slice(sorted_, 1, n - 1))
        near = F.zip_with(
            F.zip_with(sorted_, first, lambda x, y: F.struct(x.alias("x"), (x.h == y.h).alias("a"))),
            last,
            lambda p, y: F.when(p.a | (p.x.h == y.h), p.x.i),
        )
        return F.array_sort(F.array_compact(near))

    def heavy(w: Column) -> Column:
        keyed = F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return let(F.array_sort(keyed), lambda s: let(places(s), covered))

    return let(
        windows,
        lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(heavy(w)),
    )


def _windows(tokens: Column) -> Column:
    n = F.greatest(F.size(tokens) - 2, F.lit(0))
    hashed = F.transform(tokens, lambda x: F.xxhash64(x))
    return let(
        hashed,
        lambda h: F.zip_with(
            F.zip_with(F.slice(h, 1, n), F.slice(h, 2, n), lambda a, b: F.struct(a.alias("a"), b.alias("b"))),
            F.slice(h, 3, n),
            lambda p, c: F.xxhash64(p.a, p.b, c),
        ),
    )


def statistics(docs: DataFrame, text_col: str = "text", *keep: str) -> DataFrame:
    """``keep``, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_distinct."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    tokens = words(F.col(text_col))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    stats = let(
        tokens,
        lambda t: F.struct(
            F.size(t).cast("long").alias("n_words"),
            F.size(F.array_distinct(t)).cast("long").alias("n_distinct"),
            _repeated(_windows(t)).cast("long").alias("n_repeat_words"),
        ),
    )
    return docs.select(
        *keep,
        stats.alias("s"),
        F.length(F.regexp_replace(text, SPACE, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long").alias("n_dup_lines"),
        F.size(lines).cast("long").alias("n_lines"),
    ).select("*", "s.n_words", "s.n_distinct", "s.n_repeat_words").drop("s")


def features(stats: DataFrame) -> DataFrame:
    """The statistics as sizes and shares, which thresholds apply to."""
    n = F.greatest("n_words", F.lit(1))
    return stats.withColumns(
        {
            "symbol_share": F.col("n_symbols") / n,
            "dup_line_share": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
            "repeat_share": F.col("n_repeat_words") / n,
            "word_length": F.col("word_chars") / n,
            "distinct_share": F.col("n_distinct") / n,
        }
    )


@dataclass(frozen=True)
class Rule:
    """A conjunction of (feature, '<=' or '>', threshold) and what it says of a text."""

    conditions: tuple[tuple[str, str, float], ...]
    keep: bool
    precision: float

    def column(self) -> Column:
        out = F.lit(True)
        for name, sign, value in self.conditions:
            out = out & ((F.col(name) <= value) if sign == "<=" else (F.col(name) > value))
        return out


@dataclass(frozen=True)
class DecisionList:
    rules: tuple[Rule, ...] = field(default=())
    default_keep: bool = True

    def column(self) -> Column:
        """True for texts to keep: the first rule that holds decides."""
        out = F.lit(self.default_keep)
        for rule in reversed(self.rules):
            out = F.when(rule.column(), F.lit(rule.keep)).otherwise(out)
        return out


def _gain(bad: float, good: float, bad_was: float, good_was: float) -> float:
    if not bad:
        return -1.0
    return bad * (math.log2(bad / (bad + good)) - math.log2(bad_was / (bad_was + good_was)))


def learn(
    labelled: DataFrame,
    label_col: str = "quality",
    max_rules: int = 6,
    max_conditions: int = 3,
    min_precision: float = 0.9,
    min_cover: int = 5,
    cuts: int = 24,
) -> DecisionList:
    """Learn from ``labelled``: features, ``label_col`` (0 is bad) and boolean ``prune``."""
    bad = F.col(label_col) == 0
    grow, prune = ~F.col("prune"), F.col("prune")
    probes = [i / cuts for i in range(1, cuts)] + [0.005, 0.01, 0.02, 0.98, 0.99, 0.995]

    def counts(frame: DataFrame, tests: list[Column]) -> list[tuple[int, int]]:
        found = frame.agg(
            *(F.count_if(t & bad).alias(f"b{i}") for i, t in enumerate(tests)),
            *(F.count_if(t & ~bad).alias(f"g{i}") for i, t in enumerate(tests)),
        ).first()
        return [(found[f"b{i}"], found[f"g{i}"]) for i in range(len(tests))]

    def covers(frame: DataFrame, cutpoints: dict[str, list[float]]) -> dict[tuple, tuple[int, int]]:
        """(bad, good) rows that each single threshold covers, from one small histogram."""
        def cell(f: str) -> Column:
            below = F.filter(F.array(*map(F.lit, cutpoints[f])), lambda t: t < F.col(f))
            return F.struct(F.lit(f).alias("f"), F.size(below).alias("at"))

        cells = F.array(*map(cell, cutpoints))
        table = frame.select(F.explode(cells).alias("c"), bad.alias("bad"))
        held: dict[str, dict[int, tuple[int, int]]] = {f: {} for f in cutpoints}
        for r in table.groupBy("c.f", "c.at").agg(
            F.count_if("bad").alias("b"), F.count_if(~F.col("bad")).alias("g")
        ).collect():
            held[r.f][r.at] = (r.b, r.g)
        out = {}
        for f, v in cutpoints.items():
            every = [sum(x[k] for x in held[f].values()) for k in (0, 1)]
            below = [0, 0]
            for i, cut in enumerate(v):
                below = [below[k] + held[f].get(i, (0, 0))[k] for k in (0, 1)]
                out[f, "<=", cut] = (below[0], below[1])
                out[f, ">", cut] = (every[0] - below[0], every[1] - below[1])
        return out

    rules: list[Rule] = []
    rest = labelled
    for _ in range(max_rules):
        both = [F.percentile_approx(F.when(c, F.col(f).cast("double")), probes).alias(f"{f}{k}")
                for f in FEATURES for k, c in enumerate((grow, grow & bad))]
        seen = rest.agg(*both).first()
        cutpoints = {f: sorted({*(seen[f"{f}0"] or []), *(seen[f"{f}1"] or [])}) for f in FEATURES}
        cutpoints = {f: v for f, v in cutpoints.items() if v}
        if not cutpoints:
            break
        chosen: list[tuple[str, str, float]] = []
        ((bad_was, good_was),) = counts(rest, [grow])
        if bad_was < min_cover:
            break
        while len(chosen) < max_conditions and good_was:
            scored = covers(rest.filter(Rule(tuple(chosen), False, 0.0).column() & grow), cutpoints)
            was = (bad_was, good_was)
            best = max(scored, key=lambda x: _gain(*scored[x], *was))
            if _gain(*scored[best], *was) <= 0 or scored[best][0] < min_cover:
                break
            chosen.append(best)
            bad_was, good_was = scored[best]
        if not chosen:
            break
        # keep the shortest head of the conjunction that is best on the pruning rows
        heads = [tuple(chosen[: i + 1]) for i in range(len(chosen))]
        held = counts(rest, [Rule(h, False, 0.0).column() & prune for h in heads])
        value = [(b - g) / (b + g) if b + g else -1.0 for b, g in held]
        pick = max(range(len(heads)), key=lambda i: (value[i], -i))
        cover = sum(held[pick])
        precision = held[pick][0] / cover if cover else 0.0
        if precision < min_precision:
            break
        rule = Rule(heads[pick], False, precision)
        rules.append(rule)
        rest = rest.filter(~rule.column())
    return DecisionList(tuple(rules))


def learn_from(
    docs: DataFrame,
    labels: DataFrame,
    work: Work,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_rows: int = 50_000,
) -> DecisionList:
    """Learn the list from at most ``sample_rows`` labelled documents."""
    order = F.xxhash64(F.col("doc_id"), F.lit(3))
    known = (
        labels.filter("doc_id is not null and quality in (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
        .orderBy(order, "doc_id")
        .limit(sample_rows)
    )
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # at most sample_rows pairs of numbers
    sample = rows.join(F.broadcast(known), "doc_id")
    stats = features(statistics(sample, "text", "doc_id", "quality"))
    stats = stats.withColumn("prune", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(3)) == 0)
    table = work.write(stats.select(*FEATURES, "quality", "prune"), "labelled")
    return learn(table)


def judged(docs: DataFrame, rules: DecisionList, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its statistics, base_failed and kept."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return (
        features(statistics(rows, "text", "doc_id"))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & rules.column())
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                "n_repeat_words", "base_failed", "kept")
    )
