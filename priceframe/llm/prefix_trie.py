"""Operator 13: the prefix trie of conversations, its subtree totals by parallel tree contraction.

A node is a distinct sequence of first turns.  It is found by digests: a
conversation is cut into chunks of ``CHUNK`` turns; the digest of a prefix is
hashed on from the digest of the whole chunks before it, which is the same
function of the sequence of chunk digests.  So no task holds more than a chunk
of a conversation, however long that is, and the levels are log(longest) in
number.  A node is then named by its depth and its smallest member, two longs.

Subtree totals come from rounds of joins over the nodes that are left.  A round
rakes all leaves (their totals are known: they go to their parents) and
compresses unary chains: a node with one child goes if its depth has the
round's bit set and its parent's has not, which never takes two neighbours and
halves a chain; its child moves up to its parent, and what it has gathered goes
there too.  Afterwards the rounds are gone through backwards: a compressed
node's total is what it had gathered plus its child's total.  Every round works
on the nodes that are left, a shrinking share, and is written.

Members that end at a node are hashed in order of their ids: ranges of the ids
write pieces of at most ``PIECE`` ids, and one streamed SHA-256 a node reads
the pieces in order, a batch at a time.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators._util import broadcast_if_small
from .common import in_order, materialize, pick, positions, table

CHUNK = 32     #: turns of a conversation that meet in one task
PIECE = 512    #: ids of one piece of a list that is hashed
BLOCK = 100    #: conversations share the first turns of the one at the start of their block
SHARED = 6     #: a conversation takes over crc32(id) modulo this many turns


def turns(conversations: DataFrame) -> DataFrame:
    """``(c, pos, t, chars)``: a conversation's turns in order, ``t`` the digest of role and text, ``chars`` of the text."""
    role, text = F.coalesce(pick("role").cast("string"), F.lit("")), F.coalesce(pick("text").cast("string"), F.lit(""))
    rows = conversations.where(pick("conv_id").isNotNull()).select(
        pick("conv_id").cast("long").alias("c"), pick("turn").alias("turn"),
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("t"),
        F.char_length(text).cast("long").alias("chars"), F.monotonically_increasing_id().alias("tie"))
    return positions(materialize(rows, "trie-turns"), ["c"], ["turn", "t", "tie"]).select("c", "pos", "t", "chars")


def rebuilt(rows: DataFrame, block: int = BLOCK, shared: int = SHARED) -> tuple[DataFrame, DataFrame]:
    """All conversation ids ``(c)`` and the turns of the rebuilt ones ``(c, pos, t, chars)``.

    The first ``crc32(c) % shared`` turns are those of conversation ``c - c % block``
    (all if it has fewer, none if it is absent), then come c's own after as many.
    """
    convs = materialize(rows.select("c").distinct(), "trie-ids")
    base = F.col("c") - F.col("c") % block
    took = F.pmod(F.crc32(F.col("c").cast("string")), F.lit(shared))
    # At most shared - 1 turns of one conversation in a block.
    heads = materialize(rows.where((F.col("c") % block == 0) & (F.col("pos") < shared - 1))
                        .select(F.col("c").alias("base"), "pos", "t", "chars"), "trie-heads")
    lent = convs.withColumn("base", base).withColumn("h", took).join(heads, "base").where("pos < h") \
        .select("c", "pos", "t", "chars")
    there = broadcast_if_small(heads.groupBy("base").agg(F.count("*").alias("there")))
    own = rows.withColumn("base", base).withColumn("h", took).where("pos >= h").join(there, "base", "left").select(
        "c", (F.col("pos") - F.col("h") + F.least("h", F.coalesce("there", F.lit(0)))).alias("pos"), "t", "chars")
    return convs, materialize(lent.unionByName(own), "trie-rebuilt")


def prefixes(seq: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``(c, pos, p, q, chars)``: digests of the first pos + 1 and of the first pos elements of ``seq(c, pos, t, chars)``.

    The empty sequence has the empty digest.  ``chars`` passes through.
    """
    held = materialize(seq.groupBy("c", F.floor(F.col("pos") / chunk).cast("long").alias("b"))
                       .agg(F.sort_array(F.collect_list(F.struct("pos", "t", "chars"))).alias("m")), "trie-chunks")
    none = F.unhex(F.lit(""))
    join = lambda start, xs: F.aggregate(xs, start, lambda a, x: F.unhex(F.sha2(F.concat(a, x.t), 256)))
    full = held.where(F.size("m") == chunk)
    if full.head(1):
        upper = prefixes(full.select("c", F.col("b").alias("pos"), join(none, F.col("m")).alias("t"),
                                     F.lit(0).cast("long").alias("chars")), chunk)
        # A chunk starts where the whole chunks before it end; the digest after a whole chunk is theirs and its own.
        upper = upper.select(F.col("c").alias("c_"), F.col("pos").alias("b_"), F.col("p").alias("after"))
        before = upper.select("c_", (F.col("b_") + 1).alias("b_"), F.col("after").alias("start"))
        held = held.join(upper, (F.col("c") == F.col("c_")) & (F.col("b") == F.col("b_")), "left").drop("c_", "b_") \
            .join(before, (F.col("c") == F.col("c_")) & (F.col("b") == F.col("b_")), "left").drop("c_", "b_") \
            .withColumn("start", F.coalesce("start", none))
    else:
        held = held.withColumn("after", F.lit(None).cast("binary")).withColumn("start", none)
    ends = F.transform(F.sequence(F.lit(1), F.size("m")),
                       lambda i: F.when(i < chunk, join(F.col("start"), F.slice("m", F.lit(1), i))).otherwise(F.col("after")))
    rows = held.withColumn("ps", ends).select("c", "start", "ps", F.posexplode("m").alias("k", "x"))
    return rows.select("c", F.col("x.pos").alias("pos"), F.element_at("ps", F.col("k") + 1).alias("p"),
                       F.when(F.col("k") == 0, F.col("start")).otherwise(F.get("ps", F.col("k") - 1)).alias("q"),
                       F.col("x.chars").alias("chars"))


def subtree_sums(nodes: DataFrame, sums: list[str]) -> DataFrame:
    """``(d, c, *sums)`` with each of ``sums`` added up over the subtree of every node of ``nodes(d, c, pd, pc, *sums)``.

    ``(d, c)`` names a node, ``d`` its depth, and ``(pd, pc)`` its parent (null
    for a root); a parent's depth is less than its child's.  Any number of roots.
    """
    deepest = nodes.agg(F.max("d")).first()[0] or 0
    bits = max(1, int(deepest).bit_length())
    live, rounds = materialize(nodes.select("d", "c", "pd", "pc", *sums), "trie-live"), []
    while live.head(1):
        bit = 1 << (len(rounds) % bits)
        kids = live.where("pc is not null").groupBy(F.col("pd").alias("kd"), F.col("pc").alias("kc")) \
            .agg(F.count("*").alias("k"), F.min(F.struct("d", "c")).alias("kid"))
        state = live.join(kids, (F.col("d") == F.col("kd")) & (F.col("c") == F.col("kc")), "left").drop("kd", "kc")
        chain = (F.col("k") == 1) & F.col("pc").isNotNull() & (F.col("d").bitwiseAND(F.lit(bit)) != 0) \
            & (F.col("pd").bitwiseAND(F.lit(bit)) == 0)
        state = materialize(state.withColumn("gone", F.when(F.col("k").isNull(), "leaf").when(chain, "chain")), "trie-round")
        moves = state.where("gone = 'chain'").select(F.col("kid.d").alias("md"), F.col("kid.c").alias("mc"),
                                                     F.col("pd").alias("npd"), F.col("pc").alias("npc"))
        moved = state.where("gone is null or gone = 'leaf'") \
            .join(moves, (F.col("d") == F.col("md")) & (F.col("c") == F.col("mc")), "left") \
            .withColumn("pd", F.coalesce("npd", "pd")).withColumn("pc", F.coalesce("npc", "pc"))
        cols = ["pd", "pc", *sums]
        gives = moved.where("gone = 'leaf' and pc is not null").select(*cols) \
            .unionByName(state.where("gone = 'chain'").select(*cols)) \
            .groupBy(F.col("pd").alias("gd"), F.col("pc").alias("gc")).agg(*[F.sum(s).alias(f"{s}_") for s in sums])
        live = moved.where("gone is null").join(gives, (F.col("d") == F.col("gd")) & (F.col("c") == F.col("gc")), "left") \
            .select("d", "c", "pd", "pc", *[(F.col(s) + F.coalesce(F.col(f"{s}_"), F.lit(0))).alias(s) for s in sums])
        live = materialize(live, "trie-live")
        rounds.append(state)
    done = None
    for state in reversed(rounds):  # what is known of a round's nodes: the leaves, what lived on, then the chains' nodes
        known = state.where("gone = 'leaf'").select("d", "c", *sums)
        known = known if done is None else known.unionByName(done)
        below = known.select(F.col("d").alias("bd"), F.col("c").alias("bc"), *[F.col(s).alias(f"{s}_") for s in sums])
        chains = state.where("gone = 'chain'") \
            .join(below, (F.col("kid.d") == F.col("bd")) & (F.col("kid.c") == F.col("bc"))) \
            .select("d", "c", *[(F.col(s) + F.col(f"{s}_")).alias(s) for s in sums])
        done = materialize(known.unionByName(chains), "trie-known")
    return nodes.select("d", "c", *sums) if done is None else done


def hashed_lists(rows: DataFrame, keys: list[str], value: str, piece: int = PIECE) -> DataFrame:
    """``keys`` and ``sha256`` (lowercase hex) of each group's values as decimals, ascending, joined by commas.

    ``keys`` must be a long and a binary.  A group may have any share of the rows.
    """
    placed = in_order(rows.select(*keys, value), [*keys, value])
    pieces = placed.groupBy(*keys, F.floor(F.col("at") / piece).cast("long").alias("at")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(value)), lambda v: v.cast("string")), ",").alias("piece"))

    def run(batches):
        key, so_far = None, None
        for pdf in batches:
            made = []
            for a, b, text in zip(pdf[keys[0]], pdf[keys[1]], pdf["piece"], strict=True):
                if so_far is not None and (a, b) == key:
                    so_far.update(b"," + text.encode())
                    continue
                if so_far is not None:
                    made.append((*key, so_far.hexdigest()))
                key, so_far = (a, b), hashlib.sha256(text.encode())
            yield pd.DataFrame(made, columns=[*keys, "sha256"])
        if so_far is not None:
            yield pd.DataFrame([(*key, so_far.hexdigest())], columns=[*keys, "sha256"])

    return pieces.repartition(*keys).sortWithinPartitions(*keys, "at").select(*keys, "piece") \
        .mapInPandas(run, f"{keys[0]} long, {keys[1]} binary, sha256 string")


def trie(conversations: DataFrame, block: int = BLOCK, shared: int = SHARED, chunk: int = CHUNK) -> DataFrame:
    """The nodes of the prefix trie over the rebuilt conversations, the textless root at depth 0 included.

    Columns: conv_id (smallest member) and depth name a node; parent_conv_id;
    n_convs, n_children, n_leaves; saved_tokens; ends_sha256.

    Defined cases: null turns come first; turns that tie follow the digests of
    role and text, and turns that repeat altogether count each; a null role or
    text is empty; rows without a conv_id belong to no conversation; a
    conversation whose rebuilt sequence is empty is a member of the root; an
    empty table gives no rows; other columns are not read, whatever their names.
    """
    convs, seq = rebuilt(turns(conversations), block, shared)
    rows = materialize(prefixes(seq, chunk).withColumn("d", F.col("pos") + 1).drop("pos"), "trie-prefixes")
    none = F.unhex(F.lit(""))
    # One row, none for an empty table: every conversation is a member of the root.
    top = convs.agg(F.min("c").alias("c"), F.count("*").alias("n")).where("n > 0")
    top = materialize(top.select(F.lit(0).cast("long").alias("d"), none.alias("p"), "c", "n", F.lit(0).cast("long").alias("chars"),
                                 F.lit(None).cast("binary").alias("q")), "trie-root")
    below = materialize(rows.groupBy("d", "p").agg(F.min("c").alias("c"), F.count("*").alias("n"), F.max("chars").alias("chars"),
                                                   F.min("q").alias("q")).select("d", "p", "c", "n", "chars", "q"), "trie-nodes")
    up = below.select((F.col("d") + 1).alias("d"), F.col("p").alias("q"), F.col("c").alias("pc"))
    first = F.broadcast(top.select((F.col("d") + 1).alias("d"), F.col("c").alias("pc")))  # one row
    cols = ["d", "p", "c", "n", "chars", "pc"]
    nodes = below.where("d > 1").join(up, ["d", "q"]).select(*cols) \
        .unionByName(below.where("d = 1").join(first, "d").select(*cols)) \
        .unionByName(top.withColumn("pc", F.lit(None).cast("long")).select(*cols))
    nodes = materialize(nodes, "trie-linked")
    kids = nodes.where("pc is not null").groupBy((F.col("d") - 1).alias("d"), F.col("pc").alias("c")) \
        .agg(F.count("*").alias("n_children"))
    nodes = materialize(nodes.join(kids, ["d", "c"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))),
                        "trie-kids")
    sums = subtree_sums(nodes.select(
        "d", "c", F.when(F.col("pc").isNotNull(), F.col("d") - 1).alias("pd"), "pc",
        (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n") - 1) * F.col("chars")).alias("saved_tokens")), ["n_leaves", "saved_tokens"])
    last = seq.groupBy("c").agg((F.max("pos") + 1).alias("d"))
    ends = rows.select("d", "p", "c").join(last, ["d", "c"]).select("d", "p", "c") \
        .unionByName(convs.join(last, "c", "left_anti").select(F.lit(0).cast("long").alias("d"), none.alias("p"), "c"))
    ends = hashed_lists(materialize(ends, "trie-ends"), ["d", "p"], "c")
    return nodes.join(sums, ["d", "c"]).join(ends, ["d", "p"], "left").select(
        F.col("c").alias("conv_id"), F.col("d").alias("depth"), F.col("pc").alias("parent_conv_id"),
        F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved_tokens",
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie over the whole ``conversations`` table."""
    return trie(table(spark, sf_dir, "conversations"))


SQL = """
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                            sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
k AS (
  SELECT c, c - c % 100 AS base,
         xor(list_reduce(list_transform(string_split(c::VARCHAR, ''), lambda s: ord(s)::UBIGINT),
                     lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[],
                                              lambda v, w: xor(v >> 1, (v & 1) * 3988292384::UBIGINT)),
                     4294967295::UBIGINT), 4294967295::UBIGINT) % 6 AS h
  FROM (SELECT DISTINCT c FROM t)),
s AS (
  SELECT k.c, t.pos, t.r, t.x FROM k JOIN t ON t.c = k.base AND t.pos < k.h
  UNION ALL
  SELECT k.c, 1000 + t.pos, t.r, t.x FROM k JOIN t ON t.c = k.c AND t.pos >= k.h),
q AS (
  SELECT c, row_number() OVER w AS d, x,
         sha256(string_agg(strlen(r) || ':' || r || strlen(x) || ':' || x, '') OVER w) AS p FROM s
  WINDOW w AS (PARTITION BY c ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  UNION ALL SELECT c, 0, '', '' FROM k),
m AS (SELECT *, min(c) OVER (PARTITION BY d, p) AS node, max(d) OVER (PARTITION BY c) AS ends FROM q),
n AS (SELECT node, d, count(*) AS n_convs, max(length(x)) AS chars FROM m GROUP BY node, d),
links AS (SELECT DISTINCT a.node, a.d, b.node AS parent FROM m a JOIN m b ON b.c = a.c AND b.d = a.d - 1),
kids AS (SELECT parent AS node, d - 1 AS d, count(*) AS n_children FROM links GROUP BY ALL),
own AS (SELECT n.node, n.d, (n_convs - 1) * chars AS saved, CASE WHEN n_children IS NULL THEN 1 ELSE 0 END AS leaf
        FROM n LEFT JOIN kids USING (node, d)),
under AS (
  SELECT a.node, a.d, sum(own.leaf) AS n_leaves, sum(own.saved) AS saved_tokens
  FROM own JOIN m a ON a.c = own.node AND a.d <= own.d GROUP BY a.node, a.d),
e AS (SELECT node, d, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends_sha256 FROM m WHERE d = ends GROUP BY node, d)
SELECT n.node AS conv_id, n.d AS depth, links.parent AS parent_conv_id, n.n_convs,
       coalesce(kids.n_children, 0) AS n_children, under.n_leaves::BIGINT AS n_leaves,
       under.saved_tokens::BIGINT AS saved_tokens, coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM n JOIN under USING (node, d) LEFT JOIN links USING (node, d) LEFT JOIN kids USING (node, d) LEFT JOIN e USING (node, d)
"""
