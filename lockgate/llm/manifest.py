"""Merkle manifest of a table: one root over all rows, and a proof for every row.

Leaves of a source stand in the order of their ids; runs of ``ARITY`` nodes become their
hash until one is left. The tree is worked off in aligned blocks of ``ARITY ** depth``
consecutive nodes. A block keeps each of its levels as one string of hex digests, so a
run of nodes is a substring of fixed width: hashing it gives the parent, and what flanks a
node within it are the node's siblings. The digests on top of the blocks are the nodes of
the next round, until every source has one block; the sources' roots then go through the
same rounds as leaves of the tree above them.

Places come from sorted ranges of (source, id) and sums over ranges, so a source that holds
a third of all rows is spread over many tasks, and no task sees more than a block at once.
Paths come down again from the top: a block's path is computed once for all its nodes.

Null source is a source of its own and comes first. Any column may be null. Null ids come
first within their source and count as empty text in the choice of rows to tamper with;
rows of equal id are ordered by their leaves, so repeated rows are equal leaves side by
side. Texts are hashed whole, whatever their length. An empty table gives no rows. Other
columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lockgate.llm.common import Work, remainder

ARITY = 3
HEX = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """``-`` for null, else byte count, colon and value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def placed(nodes: DataFrame, order: Sequence[str], work: Work, name: str) -> DataFrame:
    """Add ``pos``, the place among the rows of a ``tree`` by ``order``, and ``n``, their number.

    Rows are sorted into ranges, numbered within them, and moved on by what earlier ranges hold.
    """
    ranged = nodes.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    ident = F.monotonically_increasing_id()  # the task's number, then the row's in its task
    ranged = ranged.select("*", F.shiftright(ident, 33).alias("range"), ident.bitwiseAND((1 << 33) - 1).alias("row"))
    ranged = work.write(ranged, name)
    parts = ranged.groupBy("range", "tree").agg(F.count("*").alias("held"), F.min("row").alias("first"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "range",
        "tree",
        (F.coalesce(F.sum("held").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("held").over(tree).alias("n"),
    )
    return ranged.join(parts, ["range", "tree"]).select(
        "tree", (F.col("row") + F.col("shift")).alias("pos"), "n", *(c for c in nodes.columns if c != "tree")
    )


def _cut(level: Column, start: Column, size: Column) -> Column:
    """``size`` digests of a level from number ``start`` on."""
    return F.substring(level, (start * HEX + 1).cast("int"), (size * HEX).cast("int"))


def _above(level: Column) -> Column:
    """The parents of a level: each run's substring, hashed."""
    nodes = (F.octet_length(level) / HEX).cast("int")
    runs = F.sequence(F.lit(0), F.ceil(nodes / ARITY).cast("int") - 1)
    joined = F.array_join(F.transform(runs, lambda i: F.sha2(_cut(level, i * ARITY, F.lit(ARITY)), 256)), "")
    return joined.cast("binary")


def blocks(nodes: DataFrame, depth: int, carried: Sequence[str] = ()) -> DataFrame:
    """One row per block of ``nodes`` (tree, pos, n, digest): members, levels, top.

    ``levels`` holds the levels that have parents, lowest first. A block goes up ``depth``
    levels where its tree has more than one block, else until one node is left. Levels are
    kept as bytes of their hex text, from which substrings are cut without counting.
    """
    width = ARITY**depth
    inside = (F.col("pos") % width).cast("int")
    member = F.struct(inside.alias("at"), "digest", *carried)
    rows = (
        nodes.groupBy("tree", "n", F.floor(F.col("pos") / width).alias("block"))
        .agg(F.sort_array(F.collect_list(member)).alias("members"))
        .withColumn("l0", F.array_join(F.col("members.digest"), "").cast("binary"))
    )
    for level in range(depth):
        more = F.col("n") > ARITY**level
        rows = rows.withColumn(f"l{level + 1}", F.when(more, _above(F.col(f"l{level}"))))
    levels = [F.when(F.col("n") > ARITY**level, F.col(f"l{level}")) for level in range(depth)]
    tops = [F.col(f"l{level}") for level in reversed(range(depth + 1))]
    return rows.select(
        "tree",
        "n",
        "block",
        "members",
        F.array_compact(F.array(*levels)).alias("levels"),
        F.coalesce(*tops).cast("string").alias("top"),
    )


def _own_path(levels: Column, at: Column) -> Column:
    """For each level, the siblings on the left and right of the node that ``at`` belongs to."""

    def siblings(level: Column, height: Column) -> Column:
        node = F.floor(at / F.pow(F.lit(ARITY), height)).cast("int")
        first = node - node % ARITY
        left, right = _cut(level, first, node - first), _cut(level, node + 1, first + (ARITY - 1) - node)
        return F.struct(left.cast("string").alias("left"), right.cast("string").alias("right"))

    return F.transform(levels, siblings)


def _members(rows: DataFrame, paths: DataFrame | None) -> DataFrame:
    """The members of blocks, each with its whole path; ``paths`` are those of the blocks."""
    if paths is not None:
        rows = rows.join(paths, ["tree", "block"])
    else:
        rows = rows.withColumn("beyond", F.array().cast("array<struct<left:string,right:string>>"))
    return rows.select("tree", "block", "levels", "beyond", "top", F.explode("members").alias("m")).select(
        "tree",
        "block",
        "m",
        F.concat(_own_path(F.col("levels"), F.col("m.at")), F.col("beyond")).alias("path"),
    )


def forest(nodes: DataFrame, depth: int, work: Work, name: str, carried: Sequence[str] = ()):
    """All blocks of all trees: (blocks by round, (tree, root) of every tree).

    The only value that comes to the driver is the size of the largest tree.
    """
    rounds = []
    largest = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        rounds.append(work.write(blocks(nodes, depth, () if rounds else carried), f"{name}-{len(rounds)}"))
        width = ARITY**depth
        if largest <= width:
            break
        done = F.col("n") <= width
        nodes = rounds[-1].filter(~done).select(
            "tree", F.col("block").alias("pos"), F.ceil(F.col("n") / width).alias("n"), F.col("top").alias("digest")
        )
        largest = -(-largest // width)
    roots = None
    for rows in rounds:
        found = rows.filter(F.col("n") <= ARITY**depth).select("tree", F.col("top").alias("digest"))
        roots = found if roots is None else roots.unionByName(found)
    return rounds, roots


def _paths(rounds: list[DataFrame], depth: int, above: DataFrame | None) -> DataFrame:
    """The members of the first round with their paths up to their tree's root and beyond.

    ``above`` holds (tree, beyond), the way from a tree's root on; a tree that is done after
    some rounds takes it from there.
    """
    width = ARITY**depth
    upper = None
    for number in reversed(range(len(rounds))):
        rows = rounds[number]
        ends = rows.filter(F.col("n") <= width).select("tree", "block")
        if above is None:
            ends = ends.withColumn("beyond", F.array().cast("array<struct<left:string,right:string>>"))
        else:
            ends = ends.join(above, "tree")
        known = ends if upper is None else ends.unionByName(upper)
        members = _members(rows, known)
        if number:
            # the members of this round are the blocks of the one below
            upper = members.select(
                "tree", (F.col("block") * width + F.col("m.at")).alias("block"), F.col("path").alias("beyond")
            )
    return members


def manifest(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    fields: Sequence[str] = FIELDS,
    tampered: Column | None = None,
    text_col: str = "text",
    depth: int = 6,
) -> DataFrame:
    """doc_id, leaf, forged, subroot, root, path for every row of ``docs``.

    ``path`` lists the siblings (left, right) from the leaf to the root. ``forged`` is the
    leaf after the text is replaced by ``tampered``, and the leaf itself without it.
    """
    work = Work(docs.sparkSession, "manifest")
    values = [F.col(name) for name in fields]
    forged = values if tampered is None else [tampered if n == text_col else F.col(n) for n in fields]
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit("")).alias("tree"),  # bytewise, null first
        F.col(id_col).alias("doc_id"),
        leaf(values).alias("digest"),
        leaf(forged).alias("forged"),
        F.monotonically_increasing_id().alias("tie"),  # spreads equal rows over ranges
    )
    leaves = work.write(leaves, "leaves")
    nodes = placed(leaves, ("doc_id", "digest", "tie"), work, "ranges").drop("tie")
    rounds, subroots = forest(nodes, depth, work, "blocks", ("doc_id", "forged"))

    tops = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("source"), "digest")
    tops = placed(work.write(tops, "subroots"), ("source",), work, "subranges")
    top_rounds, root = forest(tops, depth, work, "tops", ("source",))
    above = _paths(top_rounds, depth, None).select(
        F.col("m.source").alias("tree"), F.col("m.digest").alias("subroot"), F.col("path").alias("beyond")
    )
    above = work.write(above.crossJoin(F.broadcast(root.select(F.col("digest").alias("root")))), "above")
    members = _paths(rounds, depth, above.select("tree", "beyond"))
    named = members.join(above.select("tree", "subroot", "root"), "tree")
    return named.select(
        F.col("m.doc_id").alias("doc_id"),
        F.col("m.digest").alias("leaf"),
        F.col("m.forged").alias("forged"),
        "subroot",
        "root",
        "path",
    )


def folded(start: Column, path: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate(path, start, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def proofs(docs: DataFrame, depth: int = 6) -> DataFrame:
    """The manifest of ``documents`` with line ends taken out of every other text."""
    text = F.col("text")
    tampered = F.when(remainder("doc_id", 2) == 0, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)
    rows = manifest(docs, tampered=tampered, depth=depth)
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    root = folded(F.col("forged"), F.col("path"))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), root.alias("folded_root")
    ).select("*", (F.col("folded_root") == F.col("root")).alias("verified"))


#: The query op12 in SQL: every level of every tree, and every row's siblings joined to it.
SQL = r"""
WITH RECURSIVE head AS (
  SELECT doc_id, text, coalesce('s' || source, '') AS tree,
         coalesce(length(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
         || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-')
         || coalesce(length(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
         list_reduce(
           list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
           lambda crc, byte: list_reduce(range(8),
             lambda x, i: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END), xor(crc, byte)),
           4294967295) AS crc
  FROM documents
), base AS (
  SELECT doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(cut) || ':' || cut, '-')) AS forged
  FROM (SELECT *, CASE WHEN (4294967295 - crc) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS cut
        FROM head)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS pos,
         count(*) OVER (PARTITION BY tree) AS n
  FROM base
), nodes(tree, level, idx, h, n) AS (
  SELECT tree, 0, pos, leaf, n FROM placed
  UNION ALL
  SELECT tree, level + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (max(n) + 2) // 3
  FROM nodes WHERE n > 1 GROUP BY tree, level, idx // 3
), subroots AS (
  SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n
  FROM nodes WHERE n = 1
), tops(level, idx, h, n) AS (
  SELECT 0, pos, subroot, n FROM subroots
  UNION ALL
  SELECT level + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (max(n) + 2) // 3
  FROM tops WHERE n > 1 GROUP BY level, idx // 3
), low AS (
  SELECT p.doc_id, p.tree, x.level,
         coalesce(string_agg(x.h, '' ORDER BY x.idx) FILTER (x.idx < p.pos // CAST(power(3, x.level) AS BIGINT)), '') || '|' ||
         coalesce(string_agg(x.h, '' ORDER BY x.idx) FILTER (x.idx > p.pos // CAST(power(3, x.level) AS BIGINT)), '') AS seg
  FROM placed p JOIN nodes x
    ON x.tree = p.tree AND x.n > 1 AND x.idx // 3 = p.pos // CAST(power(3, x.level + 1) AS BIGINT)
  GROUP BY ALL
), high AS (
  SELECT s.tree, x.level,
         coalesce(string_agg(x.h, '' ORDER BY x.idx) FILTER (x.idx < s.pos // CAST(power(3, x.level) AS BIGINT)), '') || '|' ||
         coalesce(string_agg(x.h, '' ORDER BY x.idx) FILTER (x.idx > s.pos // CAST(power(3, x.level) AS BIGINT)), '') AS seg
  FROM subroots s JOIN tops x ON x.n > 1 AND x.idx // 3 = s.pos // CAST(power(3, x.level + 1) AS BIGINT)
  GROUP BY ALL
), paths AS (
  SELECT b.doc_id, b.leaf, b.forged, b.tree,
         list_concat(coalesce((SELECT list(seg ORDER BY level) FROM low WHERE low.doc_id = b.doc_id), []),
                     coalesce((SELECT list(seg ORDER BY level) FROM high WHERE high.tree = b.tree), [])) AS path
  FROM base b
), folded AS (
  SELECT doc_id, leaf, subroot, (SELECT h FROM tops WHERE n = 1) AS root,
         sha256(replace(array_to_string(path, ''), '|', '')) AS proof_sha256,
         list_reduce(path, lambda a, s: sha256(split_part(s, '|', 1) || a || split_part(s, '|', 2)), forged) AS folded_root
  FROM paths JOIN subroots USING (tree)
)
SELECT *, folded_root = root AS verified FROM folded
"""
