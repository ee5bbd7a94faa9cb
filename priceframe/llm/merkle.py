"""Operator 12: a Merkle manifest of a dataset by sibling-shift self-joins.

Every row is a leaf.  The leaves of a group, in ascending id order, are the
bottom of its tree; each run of ``arity`` consecutive nodes has one parent, the
hash of their digests, until one node is left: the group's subroot.  The
subroots, in group order, are the leaves of one more tree; its last node is the
root.  A level is one equijoin of its nodes with the indices of their siblings:
the index XOR 1 in a binary tree, else the run's start plus the slot shifted by
1 to ``arity`` - 1.  The rows of slot zero then hold a whole run and emit its
parent, so a level needs no grouping and its keys (group, index) are never hot.

Paths go back down the same levels: a node's path is its own siblings followed
by its parent's path, so the rows of a level join the rows of the next, which
are ``arity`` times fewer.  Digests are kept as 32 bytes and hashed as
lower-case hex text.  Indices come from ranges and prefix sums (``positions``),
not from a window over a group.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators._util import broadcast_if_small
from .common import materialize, pick, positions, table

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")  #: what a leaf covers, in this order
ARITY = 2


def hex_of(digest) -> Column:
    return F.lower(F.hex(digest))


def digest(text) -> Column:
    """32 bytes: SHA-256 of a string's UTF-8."""
    return F.unhex(F.sha2(text, 256))


def field(value: Column) -> Column:
    """One value of a leaf: ``-`` if null, else its UTF-8 byte count, ``:`` and the value as text."""
    v = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))


@dataclass
class Tree:
    """``levels``: the nodes of each level that have siblings or a parent, ``(g, i, n, h, left, right, ...)`` with the
    digests before and after a node in its run; ``tops(g, level, h)``: where each group ends."""

    levels: list[DataFrame]
    tops: DataFrame


def grow(nodes: DataFrame, most: int, arity: int = ARITY) -> Tree:
    """The trees over ``nodes(g long, i long, n long, h binary, ...)``: index and count within ``g``; ``most`` = max n."""
    spark = nodes.sparkSession
    levels, tops = [], nodes.where("n = 1").select("g", F.lit(0).alias("level"), "h")
    level = 0
    while most > 1:
        own = nodes.where("n > 1")
        slot = F.pmod("i", F.lit(arity))
        row = own.withColumn("slot", slot)
        found = []
        for k in range(1, arity):
            at = F.col("i").bitwiseXOR(F.lit(1)) if arity == 2 else \
                F.col("i") - F.col("slot") + F.pmod(F.col("slot") + F.lit(k), F.lit(arity))
            other = own.select(F.col("g").alias("g_"), F.col("i").alias(f"i{k}"), F.col("h").alias(f"h{k}"))
            row = row.withColumn("at", at).join(other, (F.col("g") == F.col("g_")) & (F.col("at") == F.col(f"i{k}")),
                                                "left").drop("g_", "at")
            found.append(k)
        none = F.unhex(F.lit(""))
        if arity == 2:
            left = F.when(F.col("i1") < F.col("i"), F.col("h1"))
            right = F.when(F.col("i1") > F.col("i"), F.col("h1"))
        else:
            run = F.sort_array(F.filter(F.array(*[F.struct(F.col(f"i{k}").alias("i"), F.col(f"h{k}").alias("h"))
                                                  for k in found]), lambda x: x.i.isNotNull()))
            left = F.aggregate(F.filter(run, lambda x: x.i < F.col("i")), none, lambda a, x: F.concat(a, x.h))
            right = F.aggregate(F.filter(run, lambda x: x.i > F.col("i")), none, lambda a, x: F.concat(a, x.h))
        row = row.withColumn("left", F.coalesce(left, none)).withColumn("right", F.coalesce(right, none))
        row = materialize(row.drop("slot", *[f"i{k}" for k in found], *[f"h{k}" for k in found]), "merkle-level")
        levels.append(row)
        nodes = row.where(F.pmod("i", F.lit(arity)) == 0).select(
            "g", F.floor(F.col("i") / arity).cast("long").alias("i"), F.ceil(F.col("n") / arity).cast("long").alias("n"),
            digest(F.concat(hex_of("h"), hex_of("right"))).alias("h"))
        level += 1
        most = -(-most // arity)
        tops = tops.unionByName(nodes.where("n = 1").select("g", F.lit(level).alias("level"), "h"))
    return Tree(levels, materialize(tops, "merkle-tops") if levels else tops)


def descend(tree: Tree, tops: DataFrame, arity: int = ARITY) -> DataFrame:
    """The rows of the lowest level with ``path``: an array of (left, right) digests from the node to the top.

    ``tops(g, level, path)`` says what lies above each group's last node.  A node
    alone in its group is in no level: its path is that of its group's top.
    """
    above = None
    for depth in range(len(tree.levels) - 1, -1, -1):
        ends = tops.where(F.col("level") == depth + 1).select(F.col("g").alias("g_"), F.lit(0).cast("long").alias("i_"),
                                                               F.col("path").alias("path_"))
        up = ends if above is None else above.unionByName(ends)
        row = tree.levels[depth]
        row = row.join(up, (F.col("g") == F.col("g_")) & (F.floor(F.col("i") / arity).cast("long") == F.col("i_")))
        row = row.withColumn("path", F.concat(F.array(F.struct("left", "right")), F.col("path_"))).drop("g_", "i_", "path_")
        if depth == 0:
            return row
        above = materialize(row.select(F.col("g").alias("g_"), F.col("i").alias("i_"), F.col("path").alias("path_")),
                            "merkle-paths")
    raise ValueError("a tree without levels has no paths")


def fold(start: Column, path: Column) -> Column:
    """The hex root that a leaf's hex digest and its path give."""
    return F.aggregate(path, start, lambda a, s: F.sha2(F.concat(hex_of(s.left), a, hex_of(s.right)), 256))


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", fields: tuple[str, ...] = FIELDS,
             arity: int = ARITY, changed: dict[str, Column] | None = None) -> DataFrame:
    """``(id, group, leaf, subroot, root, path, other_leaf)`` per row of ``docs``; digests as hex, ``path`` as bytes.

    ``changed`` gives other values for some fields; ``other_leaf`` is the leaf
    with them (equal to ``leaf`` where nothing changes), to be folded and held
    against ``root``.

    Defined cases: a null field is hashed as ``-``, an empty text as ``0:``;
    null ids come first in their group and null groups first of all; rows with
    one id follow their leaf digests, and rows that repeat altogether are
    leaves of their own; an empty table gives no rows; columns outside
    ``fields`` are not read, whatever their names.
    """
    def leaf(values: dict[str, Column]) -> Column:
        return digest(F.concat(*[field(values.get(f, pick(f))) for f in fields]))

    other = F.lit(None).cast("binary")
    if changed:
        same = F.lit(True)
        for f, v in changed.items():
            same = same & pick(f).eqNullSafe(v)
        other = F.when(~same, leaf(changed))
    rows = materialize(docs.select(pick(id_col).alias("id"), pick(group_col).alias("grp"), leaf({}).alias("h"),
                                   other.alias("other"), F.monotonically_increasing_id().alias("tie")), "merkle-leaves")
    rows = materialize(positions(rows, ["grp"], ["id", "h", "tie"], "i").drop("tie"), "merkle-places")
    groups = materialize(rows.groupBy("grp").agg(F.count("*").alias("n")), "merkle-groups")
    groups = positions(groups.withColumn("all", F.lit(0)), ["all"], ["grp"], "g")
    groups = broadcast_if_small(groups.select(F.col("grp").alias("grp_"), "g", "n"))
    leaves = rows.join(groups, F.col("grp").eqNullSafe(F.col("grp_"))).drop("grp_")
    # The tallest group and the number of groups: two numbers say how many levels there are.
    size = groups.agg(F.max("n").alias("most"), F.count("*").alias("groups")).first()
    tree = grow(leaves, int(size["most"] or 0), arity)
    tops = materialize(tree.tops.select(F.lit(0).cast("long").alias("g"), F.col("g").alias("i"),
                                        F.lit(size["groups"]).cast("long").alias("n"), "h", "level"), "merkle-subroots")
    crown = grow(tops, int(size["groups"]), arity)
    root = F.broadcast(crown.tops.select(F.col("g").alias("g_"), F.col("h").alias("root")))  # one row
    nothing = F.array().cast("array<struct<left:binary,right:binary>>")
    high = descend(crown, crown.tops.select("g", "level", nothing.alias("path")), arity) if crown.levels else \
        tops.withColumn("path", nothing)
    high = high.join(root, F.col("g") == F.col("g_"))
    high = broadcast_if_small(high.select(F.col("i").alias("g"), "level", F.col("h").alias("subroot"), "root", "path"))
    # A leaf alone in its group is the subroot; the others meet their parents' paths.
    cols = ["g", "id", "grp", "h", "other", "path"]
    lone = leaves.where("n = 1").join(high.select("g", "path"), "g").select(*cols)
    low = lone if not tree.levels else descend(tree, high.select("g", "level", "path"), arity).select(*cols).unionByName(lone)
    return low.join(high.select(F.col("g").alias("g_"), "subroot", "root"), F.col("g") == F.col("g_")).select(
        "id", F.col("grp").alias("group"), hex_of("h").alias("leaf"), hex_of("subroot").alias("subroot"),
        hex_of("root").alias("root"), "path", hex_of(F.coalesce("other", "h")).alias("other_leaf"))


def verify(rows: DataFrame) -> DataFrame:
    """``manifest`` rows with ``proof_sha256``, ``folded_root`` from ``other_leaf`` and ``verified`` (equals ``root``)."""
    proof = F.sha2(F.array_join(F.transform("path", lambda s: F.concat(hex_of(s.left), hex_of(s.right))), ""), 256)
    rows = rows.withColumn("proof_sha256", proof).withColumn("folded_root", fold(F.col("other_leaf"), F.col("path")))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of the whole ``documents`` table, one tree per lang; n_chars is changed where 7 divides crc32(doc_id)."""
    docs = table(spark, sf_dir, "documents")
    hit = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0, F.lit(False))
    rows = manifest(docs, changed={"n_chars": F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))})
    return verify(rows).select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root",
                               "verified")


SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, lang, n_chars,
         concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-'),
                coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-')) AS head,
         coalesce(strlen(text) || ':' || text, '-') AS tail,
         list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::UBIGINT),
                     lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[],
                                           lambda x, y: xor(x >> 1, (x & 1) * 3988292384::UBIGINT)),
                     4294967295::UBIGINT) AS crc
  FROM documents),
leaves AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') || tail) AS h,
         sha256(head || coalesce(strlen((n_chars + bad)::VARCHAR) || ':' || (n_chars + bad)::VARCHAR, '-') || tail) AS b
  FROM (SELECT *, CASE WHEN xor(crc, 4294967295::UBIGINT) % 7 = 0 THEN 1 ELSE 0 END AS bad FROM d)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS i,
         count(*) OVER (PARTITION BY lang) AS n, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g
  FROM leaves),
low AS (
  SELECT g, 0 AS level, i, n, h FROM placed
  UNION ALL
  SELECT g, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM low WHERE n > 1
  GROUP BY g, level, i // 2, n),
subroots AS (SELECT g, h FROM low WHERE n = 1),
high AS (
  SELECT 0 AS level, g AS i, count(*) OVER () AS n, h FROM subroots
  UNION ALL
  SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM high WHERE n > 1
  GROUP BY level, i // 2, n),
steps AS (
  SELECT p.doc_id, p.h, p.i, p.g, t.level AS step, s.h AS sib, (p.i >> t.level) % 2 = 1 AS before
  FROM placed p JOIN (SELECT DISTINCT g, level FROM low WHERE n > 1) t ON t.g = p.g
  LEFT JOIN low s ON s.g = p.g AND s.level = t.level AND s.i = xor(p.i >> t.level, 1::BIGINT)
  UNION ALL
  SELECT p.doc_id, p.h, p.i, p.g, 1000 + t.level, s.h, (p.g >> t.level) % 2 = 1
  FROM placed p CROSS JOIN (SELECT DISTINCT level FROM high WHERE n > 1) t
  LEFT JOIN high s ON s.level = t.level AND s.i = xor(p.g >> t.level, 1::BIGINT)),
lists AS (
  SELECT h, i, g, sha256(coalesce(string_agg(sib, '' ORDER BY step), '')) AS proof_sha256,
         list({'s': sib, 'b': before} ORDER BY step) AS path
  FROM steps GROUP BY h, i, g),
folded AS (
  SELECT p.g, p.i, 0 AS k, p.b AS acc FROM placed p
  UNION ALL
  SELECT f.g, f.i, f.k + 1, sha256(CASE WHEN l.path[f.k + 1].b THEN coalesce(l.path[f.k + 1].s, '') || f.acc
                                        ELSE f.acc || coalesce(l.path[f.k + 1].s, '') END)
  FROM folded f JOIN lists l ON l.g = f.g AND l.i = f.i WHERE f.k < len(l.path))
SELECT p.doc_id, p.h AS leaf, s.h AS subroot, r.h AS root, coalesce(l.proof_sha256, sha256('')) AS proof_sha256,
       f.acc AS folded_root, f.acc = r.h AS verified
FROM placed p JOIN subroots s ON s.g = p.g CROSS JOIN (SELECT h FROM high WHERE n = 1) r
LEFT JOIN lists l ON l.g = p.g AND l.i = p.i
JOIN folded f ON f.g = p.g AND f.i = p.i AND f.k = coalesce(len(l.path), 0)
"""
