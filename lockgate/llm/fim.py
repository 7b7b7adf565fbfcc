"""Fill-in-middle transformation by regular expressions with counted quantifiers.

A text is a row of units: runs of ASCII letters, and every other code point by itself.
``regexp_count`` gives their number; two hashes of the id choose the cuts. A pattern made
for the row then matches the whole text once: ``(unit{a}+)(unit{b-a}+)(rest)``. Its groups
are prefix, middle and suffix, and one replacement puts them in the order of the form.
Possessive quantifiers keep the matcher in a loop: nothing is given back, so neither time
nor stack grows beyond the length of the text. Every row is transformed by itself, without
a shuffle.

Null text counts as empty and an empty text stays plain; a null id counts as empty text in
the hashes. Texts of any length are cut whole. Repeated rows give repeated results, rows
that share an id get the same hashes, and an empty table gives no rows. Other columns are
not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = "[A-Za-z]+|[^A-Za-z]"
#: Fixed markers of the output.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

_STEP = "(?:[A-Za-z]++|[^A-Za-z])"
_ORDER = {
    "psm": f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2",
    "spm": f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2",
}
_PARTS = {
    "psm": (rf"(?s)\A{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}(.*)\z", "$1$3$2"),
    "spm": (rf"(?s)\A{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE}(.*)\z", "$2$3$1"),
}


def _hash(number: int, digest: Column) -> Column:
    group = F.substring(digest, 8 * number - 7, 8)
    return F.conv(group, 16, 10).cast("long")


def transformed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: str = "1:",
    rate: int = 90,
    suffix_first: int = 20,
) -> DataFrame:
    """doc_id, text, n, form, prefix_chars, middle_chars, output for every row.

    ``rate`` percent of the texts are transformed, ``suffix_first`` percent of those with
    the suffix in front. A text that holds a marker stays plain, so a transformed one can
    always be taken apart again.
    """
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.sha2(F.concat(F.lit(seed), ident), 256).alias("digest"),
    )
    text = F.col("text")
    marked = F.lit(False)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(text, F.lit(marker))
    plain = (text == "") | marked | (_hash(3, F.col("digest")) % 100 >= rate)
    rows = rows.select(
        "doc_id",
        "text",
        F.regexp_count(text, F.lit(UNIT)).cast("long").alias("n"),
        *(_hash(i, F.col("digest")).alias(f"h{i}") for i in (1, 2)),
        F.when(plain, "plain")
        .when(_hash(4, F.col("digest")) % 100 < suffix_first, "spm")
        .otherwise("psm")
        .alias("form"),
    )
    cuts = [F.col(h) % (F.col("n") + 1) for h in ("h1", "h2")]
    rows = rows.select("doc_id", "text", "n", "form", F.least(*cuts).alias("a"), F.greatest(*cuts).alias("b"))
    pattern = F.format_string(
        rf"(?s)\A({_STEP}{{%d}}+)({_STEP}{{%d}}+)(.*+)\z", F.col("a"), F.col("b") - F.col("a")
    )
    order = F.when(F.col("form") == "spm", _ORDER["spm"]).otherwise(_ORDER["psm"])
    output = F.when(F.col("form") == "plain", text).otherwise(F.regexp_replace(text, pattern, order))
    rows = rows.select("doc_id", "text", "n", "form", output.alias("output"))

    # a transformed text holds each marker once, so places of markers give the lengths
    at = {m: F.instr(F.col("output"), m) for m in (PREFIX, SUFFIX, MIDDLE)}
    after_prefix = F.when(F.col("form") == "spm", at[MIDDLE]).otherwise(at[SUFFIX])
    cut = F.col("form") != "plain"
    size = len(MIDDLE)
    return rows.select(
        "doc_id",
        "text",
        "n",
        "form",
        F.when(cut, after_prefix - at[PREFIX] - size).cast("long").alias("prefix_chars"),
        F.when(cut, F.length("output") - at[MIDDLE] - (size - 1)).cast("long").alias("middle_chars"),
        "output",
    )


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from."""
    result = output
    for name, (pattern, order) in _PARTS.items():
        result = F.when(form == name, F.regexp_replace(output, pattern, order)).otherwise(result)
    return result


def digests(rows: DataFrame) -> DataFrame:
    """:func:`transformed` with digests of the output and of the text rebuilt from it."""
    return rows.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


#: The query op13 in SQL; lists of units take the place of the pattern.
SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || CAST(doc_id AS VARCHAR)) AS d
  FROM documents
), h AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n,
         CAST('0x' || d[1:8] AS BIGINT) AS h1, CAST('0x' || d[9:16] AS BIGINT) AS h2,
         CAST('0x' || d[17:24] AS BIGINT) AS h3, CAST('0x' || d[25:32] AS BIGINT) AS h4
  FROM t
), c AS (
  SELECT doc_id, text, n, u, least(h1 % (n + 1), h2 % (n + 1)) AS a,
         greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM h
), p AS (
  SELECT doc_id, text, n, form, array_to_string(u[1:a], '') AS p,
         array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:n], '') AS s
  FROM c
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
