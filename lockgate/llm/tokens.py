"""Token counts and ids of whole texts by public tokenizers, a segment at a time.

A text is cut where a space stands between two other characters. Neither of the two
vocabularies has a piece across such a place, so a text's tokens are the tokens of its
segments in a row, and segments can be encoded once and remembered. A batch's new
segments go to the library in parts of about ``PART_BYTES``; only lengths (or ids) are
kept, in a memory of at most ``MEMORY`` segments for each Python worker.

Null text counts as empty; an empty text has no tokens.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART_BYTES = 1 << 20
MEMORY = 400_000
LONG = 400  # longer segments are encoded but not remembered
#: A segment: the spaces before a word but for the first, which the cut takes, and the word.
_SEGMENTS = re.compile(r"(?:\A *| +)[^ ]+(?: +\Z)?|\A +\Z")

_memories: dict[str, dict] = {}


def parts(segments: list[str], most: int = PART_BYTES) -> Iterator[list[str]]:
    """``segments`` in lists of about ``most`` bytes each."""
    part: list[str] = []
    held = 0
    for s in sorted(segments, key=len):
        part.append(s)
        held += len(s) + 8
        if held >= most:
            yield part
            part, held = [], 0
    if part:
        yield part


def runs(texts: list[str], most: int = PART_BYTES) -> Iterator[slice]:
    """Slices of ``texts`` that hold about ``most`` characters each, at least one text."""
    start = held = 0
    for i, text in enumerate(texts, 1):
        held += len(text)
        if held >= most:
            yield slice(start, i)
            start, held = i, 0
    if start < len(texts):
        yield slice(start, len(texts))


def segments_of(text: str) -> list[str]:
    """The segments of ``text``; all but the first have lost the space at the cut."""
    if "  " not in text and not text.startswith(" ") and not text.endswith(" "):
        return text.split(" ") if text else []
    found = _SEGMENTS.findall(text)
    return [found[0], *(s[1:] for s in found[1:])] if found else []


class Remembered:
    """``encode`` for single segments with a bounded memory."""

    def __init__(self, name: str, encode: Callable[[list[str]], list]) -> None:
        self.known = _memories.setdefault(name, {})
        self.encode = encode

    def table(self, wanted: set[str]) -> dict:
        """A table that holds a value for each of ``wanted``."""
        known = self.known
        if len(known) > MEMORY:
            known.clear()
        missing = [s for s in wanted if s not in known]
        long: dict = {}
        for part in parts(missing):
            for s, value in zip(part, self.encode(part), strict=True):
                (long if len(s) > LONG else known)[s] = value
        return {**{s: known[s] for s in wanted if s in known}, **long} if long else known


_processors: dict = {}


def _sentencepiece(path: str):
    if path not in _processors:
        import sentencepiece

        _processors[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _processors[path]


def piece_counts(texts: list[str], path: str) -> list[int]:
    """Tokens of each text by the sentencepiece model at ``path``."""
    processor = _sentencepiece(path)

    def lengths(part: list[str]) -> list[int]:
        return [len(ids) for ids in processor.encode(part, num_threads=1)]

    memory = Remembered(path, lengths)
    # the model writes a space as U+2581, so both are one character to it
    cut = [segments_of(t.replace("▁", " ")) for t in texts]
    table = memory.table(set().union(*cut) if cut else set())
    return [sum(map(table.__getitem__, c)) for c in cut]


def token_counts(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row of ``docs``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            counts = [n for run in runs(texts) for n in piece_counts(texts[run], path)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes")
    )
    kind = dict(rows.dtypes)["doc_id"]
    counted = rows.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
