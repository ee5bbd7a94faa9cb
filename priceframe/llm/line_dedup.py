"""Operator 5: line dedup by a segment-partition edit join.

Two lines link when they are equal, or both have at least ``MIN_CHARS`` code
points and their edit distance is at most ``EDITS``.  Of a connected class of
lines, over the whole corpus, the first occurrence stays (least document id,
then position); the others are cut from their texts.

Join: a line of length l is split into EDITS + 1 segments as equal as can be, each
an index row (segment number, l, its characters).  A line probes, for every
length from its own to EDITS shorter and every segment, the substrings that a
segment left whole can stand at (the multi-match-aware window), so two lines
within EDITS meet on at least one key.  Pairs that meet are verified by cheap
bounds (letter counts, then the share of equal pieces) and by ``levenshtein`` where
these leave it open.  All is DataFrame functions; ``within`` is a second distance
in numpy, which the tests hold the columns against.

Scale: one scan turns lines into hashes and keys, which are written once; all
that follows is over these narrow rows.  The join is over distinct lines, so a
line that a third of all documents repeat is one row, and letter counts that ride
along rule out most pairs inside it.  A segment that very many lines share makes
no pairs: its lines are folded chunk by chunk to spanning forests.  Text of
lines is moved only for candidates, texts of documents only where lines are cut; both are found
at the scan by bit sets of bounded size (``bit_sketch``).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import (bit_sketch, bucket_of, caller_row, components, materialize, maybe_in, member_sketch, pick,
                     table)

EDITS = 2          #: edit distance up to which lines link: two typos, a changed two-digit number or date
MIN_CHARS = 16     #: code points below which only equal lines link
#: Letters whose counts bound the edit distance from below before texts are fetched.
COUNTED = "etaoinshr"
HOT = 64           #: lines on a key above which it makes no pairs
BLOCK = 128        #: lines of a chunk of such a key, about
PIECES = 5         #: pieces of a line that two lines within the edits share, of EDITS more
FINE = 4           #: code points of the pieces that are asked next
CELLS = 1 << 21    #: characters of pairs that ``within`` takes together


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per non-blank line: ``(id, tk, pos, line)``; tk tells apart texts that share an id."""
    # A text is hashed below the split: beside it, it would be hashed for every line.
    rows = docs.select(pick(id_col).alias("id"), pick(text_col).cast("string").alias("text"))
    rows = rows.withColumn("tk", F.xxhash64("text"))
    return rows.select("id", "tk", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line")) \
        .where(F.col("line").rlike("[^\\s]"))


def _segments(length, edits: int):
    """(start from 1, length) columns of each of the segments of a line of ``length``."""
    parts = edits + 1
    low = F.floor(length / F.lit(parts)).cast("int")
    longer = length - low * parts      # this many segments, the last ones, are one longer
    out, start = [], F.lit(1)
    for i in range(parts):
        size = low + F.when(F.lit(i) >= F.lit(parts) - longer, 1).otherwise(0)
        out.append((start, size))
        start = start + size
    return out


def _key(i: int, length, chars):
    return F.xxhash64(F.lit(i), length.cast("int"), chars)


def index_keys(line, n, edits: int = EDITS) -> list:
    """The keys of a line's own segments; ``n`` is a column with its length, counted once for all keys."""
    return [_key(i, n, F.substring(line, s, z)) for i, (s, z) in enumerate(_segments(n, edits))]


def probe_places(edits: int = EDITS) -> list[tuple[int, int, int]]:
    """(shorter by, segment, shift) of every place a whole segment of a line up to ``edits`` shorter can stand at.

    A line's own segments at shift 0 are left out: they are its index keys.
    """
    out = []
    for less in range(edits + 1):
        for i in range(edits + 1):
            left, right = i, edits - i     # edits that may come before and after this segment
            out += [(less, i, shift) for shift in range(max(-left, less - right), min(left, less + right) + 1)
                    if less or shift]
    return out


def probe_keys(line, n, edits: int = EDITS) -> list:
    """The keys at ``probe_places``, null where a substring would leave the line of ``n`` code points."""
    out = []
    for less, i, shift in probe_places(edits):
        s, z = _segments(n - less, edits)[i]
        at = s + shift
        out.append(F.when((at >= 1) & (at + z - 1 <= n), _key(i, n - less, F.substring(line, at, z))))
    return out


def within(lines: list[str], ia: np.ndarray, ib: np.ndarray, edits: int = EDITS) -> np.ndarray:
    """Whether lines[ia[k]] and lines[ib[k]] are at most ``edits`` apart: banded, bit-parallel over the band's diagonals.

    Bit d + edits of word e after j characters of b says that a's first j + d
    characters can become b's first j with at most e edits.  Many pairs take a
    step together; those without a reachable diagonal leave.
    """
    size = np.array([len(x) for x in lines], dtype=np.int64)
    out = np.zeros(len(ia), dtype=bool)
    todo = np.flatnonzero(np.abs(size[ia] - size[ib]) <= edits)
    todo = todo[np.argsort(-size[ib[todo]], kind="stable")]
    at = 0
    while at < len(todo):  # the longest first: a slice's first pair tells how many fit
        part = todo[at:at + max(1, CELLS // int(size[ib[todo[at]]] + 2 * edits + 1))]
        out[part] = _steps(lines, ia[part], ib[part], size, edits)
        at += len(part)
    return out


def _steps(lines: list[str], ia: np.ndarray, ib: np.ndarray, size: np.ndarray, edits: int) -> np.ndarray:
    """``within`` for pairs in descending length of the second line, whose lengths differ by ``edits`` at most."""
    used, place = np.unique(np.concatenate([ia, ib]), return_inverse=True)
    table_ = np.full((int(size[used].max()) + 2 * edits + 1, len(used)), 0xFFFFFFFF, dtype=np.uint32)
    for col, k in enumerate(used.tolist()):  # characters start in row ``edits``; what pads them equals none
        table_[edits:edits + len(lines[k]), col] = np.frombuffer(lines[k].encode("utf-32-le", "surrogatepass"), "<u4")
    a, b = table_[:, place[:len(ia)]], table_[:, place[len(ia):]]
    nb, last = size[ib], (size[ia] - size[ib] + edits).astype(np.uint32)
    full = np.uint32((1 << (2 * edits + 1)) - 1)
    words = [np.full(len(ia), sum(1 << (d + edits) for d in range(e + 1)), dtype=np.uint32) for e in range(edits + 1)]
    out, who, one = np.zeros(len(ia), dtype=bool), np.arange(len(ia)), np.uint32(1)
    for j in range(int(nb[0]) + 1):
        going = int(np.searchsorted(-nb, -j, side="left"))  # pairs whose second line has a character j
        if going < len(who):
            out[who[going:]] = (words[edits][going:] >> last[going:]) & one == 1
            who, nb, last, a, b = who[:going], nb[:going], last[:going], a[:, :going], b[:, :going]
            words = [w[:going] for w in words]
        if j % 16 == 15:
            live = np.flatnonzero(words[edits])
            if 2 * len(live) < len(who):
                who, nb, last, a, b = who[live], nb[live], last[live], a[:, live], b[:, live]
                words = [w[live] for w in words]
        if not len(who):
            break
        match = np.zeros(len(who), dtype=np.uint32)
        for d in range(2 * edits + 1):
            match |= (a[j + d] == b[j + edits]).astype(np.uint32) << np.uint32(d)
        new = []
        for e, old in enumerate(words):
            w = old & match
            if e:
                w |= words[e - 1] | (words[e - 1] >> one) | (new[e - 1] << one)
            new.append(w & full)
        words = new
    return out


#: Seven bits for a count modulo 14, ones that fill up and empty again: neighbours differ in one bit.
_STEPS = [(1 << r) - 1 if r <= 7 else 127 & -(1 << (r - 7)) for r in range(14)]


def letter_counts(line):
    """The counts, modulo 14, of some letters in seven bits each (``_STEPS``)."""
    sig = F.lit(0).cast("long")
    for i, letter in enumerate(COUNTED):
        times = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(letter), F.lit("")))
        code = F.get(F.array(*[F.lit(x).cast("long") for x in _STEPS]), F.pmod(times, F.lit(14)).cast("int"))
        sig = sig + F.shiftleft(code, 7 * i)
    return sig


def _apart(a, b):
    """A lower bound of twice the edit distance: an edit changes at most two letter counts by one, a bit each."""
    return F.bit_count(a.bitwiseXOR(b))


def alike(a, b, edits: int = EDITS):
    """Whether the lines of two structs (sig, n, line) are at most ``edits`` apart; the cheap bounds come first.

    Of ``edits`` + PIECES equal pieces of a line, each edit breaks one at most: the
    others stand in the other line, shifted by ``edits`` places at most.  So it is
    with pieces of FINE code points, which are asked of what is left.
    """
    parts, x, y = edits + PIECES, a["line"], b["line"]
    shifts = F.array(*[F.lit(s) for s in sorted(range(-edits, edits + 1), key=abs)])
    broken = F.filter(F.sequence(F.lit(1), a["n"], F.lit(FINE)), lambda at: ~F.exists(
        shifts, lambda s: F.substring(x, at, F.lit(FINE)) == F.substring(y, F.greatest(at + s, F.lit(1)), F.least(
            F.lit(FINE), a["n"] - at + 1))))
    whole = F.lit(0)
    for i in range(parts):
        start, end = [F.floor(a["n"] * F.lit(k) / F.lit(parts)).cast("int") for k in (i, i + 1)]
        piece, found = F.substring(x, start + 1, end - start), F.lit(False)
        for shift in sorted(range(-edits, edits + 1), key=abs):
            found = found | (piece == F.substring(y, start + 1 + shift, end - start))
        whole = whole + found.cast("int")
    return (F.abs(a["n"] - b["n"]) <= edits) & (_apart(a["sig"], b["sig"]) <= 2 * edits) & (whole >= PIECES) \
        & (F.size(broken) <= edits) & (F.levenshtein(x, y, edits) >= 0)


def forest(lines, edits: int = EDITS):
    """The classes of two lines and more among an array of them, each an array of places (from 0).

    Line by line: the classes so far in which it meets a line become one with it;
    of a class, lines are compared until one meets.
    """
    def join(trees, x):
        seen = F.transform(trees, lambda t: F.struct(
            t.alias("t"), F.exists(t, lambda y: alike(F.get(lines, x), F.get(lines, y), edits)).alias("hit")))
        return F.get(F.transform(F.array(seen), lambda s: F.concat(
            F.transform(F.filter(s, lambda z: ~z["hit"]), lambda z: z["t"]),
            F.array(F.concat(F.flatten(F.transform(F.filter(s, lambda z: z["hit"]), lambda z: z["t"])), F.array(x))))), F.lit(0))

    trees = F.aggregate(F.sequence(F.lit(0), F.size(lines) - 1), F.array().cast("array<array<int>>"), join)
    return F.filter(trees, lambda t: F.size(t) > 1)


def line_links(docs: DataFrame, distinct: DataFrame, id_col: str, text_col: str, edits: int, min_chars: int,
               hot: int = HOT, block: int = BLOCK) -> DataFrame:
    """``(u, v)`` names of lines, which connect them as all links within ``edits`` would.

    ``distinct`` has (h1, ks, ps) of the distinct long lines.  A probe meets
    at most ``hot`` lines on a key.  Keys that more lines have make no pairs: their
    lines are cut into chunks, and each pair of chunks is folded to a spanning forest.
    """
    index = distinct.select("h1", F.explode("ks").alias("key"))
    by = F.col("h1").alias("by")
    less = F.array(*[F.lit(x) for x, _, _ in probe_places(edits)])
    asked = distinct.select(by, F.explode("ks").alias("key"), F.lit(0).alias("less")).unionByName(
        distinct.select(by, F.posexplode("ps").alias("at", "key")).where("key is not null")
        .withColumn("less", F.get(less, F.col("at"))).drop("at"))
    counts = index.groupBy("key").agg(F.count("*").alias("n"))
    crowded = materialize(counts.where(F.col("n") > hot).select("key"), "line-hot")

    # First the probes that meet any line, without forming pairs: most lines meet none and are left behind here.
    few = index.join(counts.where(F.col("n") <= hot), "key", "left_semi")
    meets = F.col("h1").isNotNull() & (F.col("h1") != F.col("by")) & ((F.col("less") > 0) | (F.col("h1") < F.col("by")))
    live = materialize(asked.join(few.withColumnRenamed("key", "own"), (F.col("key") == F.col("own")) & meets, "left_semi"),
                       "line-live")
    sketch = member_sketch(live, F.col("key"))
    found = materialize(index.withColumn("bucket", bucket_of(F.col("key"))).join(sketch, "bucket", "left_semi")
                        .join(live.select("key").distinct(), "key", "left_semi").select("key", "h1"), "line-found")
    sketch = member_sketch(crowded, F.col("key"))
    members = index.select("key", "h1").unionByName(asked.select("key", F.col("by").alias("h1"))) \
        .withColumn("bucket", bucket_of(F.col("key"))).join(sketch, "bucket", "left_semi") \
        .join(crowded, "key", "left_semi").select("key", "h1").distinct()
    members = materialize(members, "line-members")
    sizes = materialize(members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "line-sizes")

    # The texts of all these lines, from a scan that the sketch of their hashes narrows.
    hashes = live.select(F.col("by").alias("h1")).union(found.select("h1")).union(members.select("h1"))
    wanted = bit_sketch(hashes, F.col("h1"))
    long = _lines(docs, id_col, text_col).where(F.char_length("line") >= min_chars).withColumn("h1", F.xxhash64("line"))
    texts = (maybe_in(long.select("h1", "line"), wanted, F.col("h1")).where("maybe")
             .withColumn("h2", F.xxhash64(F.lit(11), "line")).groupBy("h1", "h2").agg(F.first("line").alias("line")))
    texts = materialize(texts.select("h1", _name("h1", "h2").alias("name"), letter_counts(F.col("line")).alias("sig"), "line"),
                        "line-texts")
    # Letter counts ride along: a pair they rule out never leaves the join.
    signed = texts.select("h1", "sig").distinct()
    met = live.join(signed.select(by, F.col("sig").alias("by_sig")), "by").join(found.join(signed, "h1"), "key") \
        .where(meets & (_apart(F.col("sig"), F.col("by_sig")) <= 2 * edits)).select("h1", "by").distinct()
    met = materialize(met, "line-pairs")
    line = F.struct("name", "sig", F.char_length("line").alias("n"), "line")
    sides = texts.select("h1", line.alias("a"))
    pairs = met.join(sides, "h1").join(sides.select(by, F.col("a").alias("b")), "by") \
        .where(alike(F.col("a"), F.col("b"), edits)).select(F.col("a.name").alias("u"), F.col("b.name").alias("v"))

    chunks = F.ceil(F.col("n") / F.lit(block)).cast("int")
    rows = (members.join(sizes, "key").join(sides, "h1")
            .withColumn("g", F.pmod(F.xxhash64(F.lit(7), "h1"), chunks.cast("long")).cast("int"))
            .withColumn("o", F.explode(F.sequence(F.lit(0), chunks - 1)))
            .select("key", F.least("g", "o").alias("i"), F.greatest("g", "o").alias("j"), "a"))
    folded = rows.groupBy("key", "i", "j").agg(F.collect_list("a").alias("lines")).where(F.size("lines") > 1) \
        .select("lines", F.explode(forest(F.col("lines"), edits)).alias("tree")) \
        .select(F.col("lines")[F.col("tree")[0]]["name"].alias("u"),
                F.explode(F.transform(F.slice("tree", 2, F.size("tree")), lambda y: F.col("lines")[y]["name"])).alias("v"))
    return pairs.unionByName(folded)


def _name(a: str, b: str):
    return F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0"))


def _half(name: str, at: int):
    """The hash whose sixteen digits begin at ``at`` of a ``_name``."""
    return F.conv(F.substring(name, at, 16), 16, -10).cast("long")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS,
               min_chars: int = MIN_CHARS, hot: int = HOT, block: int = BLOCK) -> DataFrame:
    """The columns of ``docs`` with repeated lines cut from the text, and ``dropped``, the positions cut (from 0).

    Lines are what line feeds part; blank lines are kept and never linked.

    Defined cases: a null text stays null and an empty one empty, with nothing
    dropped; a null id orders after all others; rows that repeat an id and text
    are one occurrence and get the same result; a text all of whose lines are
    cut becomes empty but the row stays; an empty table gives no rows; columns
    with other names pass unchanged, but ``dropped`` is replaced.
    """
    if min_chars <= edits:
        raise ValueError("min_chars must be above edits: every segment needs a character")
    line, n = F.col("line"), F.col("n")
    long = n >= min_chars
    # The length is a column of its own below the keys: each of them would count the code points anew.  Short lines
    # get keys, too, which nobody reads: under a condition the keys' common parts would be computed again and again.
    rows = materialize(_lines(docs, id_col, text_col).withColumn("n", F.char_length("line")).select(
        F.struct(F.col("id").isNull().alias("none"), "id", "tk", "pos").alias("o"),
        F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(11), line).alias("h2"), long.alias("long"), F.array(*index_keys(line, n, edits)).alias("ks"),
        F.array(*probe_keys(line, n, edits)).alias("ps")), "line-rows")
    occurrences = rows.select("h1", "h2", "o")
    classes = materialize(rows.groupBy("h1", "h2").agg(
        F.min("o").alias("first"), F.count("*").alias("n"), F.first("long").alias("long"), F.first("ks").alias("ks"),
        F.first("ps").alias("ps")), "lines")
    links = materialize(line_links(docs, classes.where("long"), id_col, text_col, edits, min_chars, hot, block),
                        "line-links")
    star = materialize(components(links), "line-star")
    named = star.select(F.col("u").alias("name"), "root").unionByName(
        star.select(F.col("root").alias("name"), "root").distinct())
    named = materialize(named.withColumn("h1", _half("name", 1)).withColumn("h2", _half("name", 17)).select("h1", "h2", "root"),
                        "line-named")
    linked = materialize(maybe_in(classes.select("h1", "h2", "first"), bit_sketch(named, F.col("h1")), F.col("h1"))
                         .where("maybe").join(named, ["h1", "h2"]).select("h1", "h2", "first", "root"), "line-linked")
    firsts = materialize(linked.groupBy("root").agg(F.min("first").alias("least")), "line-firsts")
    alike = linked.join(firsts, "root").select("h1", "h2", F.col("least").alias("first"))
    multi = materialize(classes.where("n > 1").join(linked, ["h1", "h2"], "left_anti").select("h1", "h2", "first")
                        .unionByName(alike), "line-multi")
    both = F.xxhash64("h1", "h2")
    cut = (maybe_in(occurrences, bit_sketch(multi, both), both).where("maybe").drop("maybe")
           .join(multi, ["h1", "h2"]).where("o <> first")
           .groupBy(F.col("o.id").alias("__id"), F.col("o.tk").alias("__tk"))
           .agg(F.array_sort(F.collect_set("o.pos")).alias("__dropped")))
    cut = materialize(cut, "line-cut")

    key = F.xxhash64(F.col("__id"), F.col("__tk"))
    rest = docs.select(*[pick(c) for c in docs.columns if c != "dropped"])
    text = F.xxhash64(pick(text_col).cast("string"))
    rows = rest.select(pick(id_col).alias("id"), text.alias("tk"), caller_row(rest))
    rows = maybe_in(rows, bit_sketch(cut, key), F.xxhash64(F.col("id"), F.col("tk")))
    same = rows.where("not maybe").select("row", F.lit(None).cast("array<int>").alias("cut"))
    maybe = rows.where("maybe")
    on = maybe["id"].eqNullSafe(cut["__id"]) & (maybe["tk"] == cut["__tk"])
    changed = maybe.join(cut, on, "left").select("row", F.col("__dropped").alias("cut"))
    kept = F.array_join(F.filter(F.split(F.col("row")[text_col].cast("string"), "\n", -1),
                                 lambda x, i: ~F.array_contains(F.col("cut"), i)), "\n")
    return same.unionByName(changed).select(
        *[F.when(F.col("cut").isNull(), F.col("row")[c]).otherwise(kept).alias(c) if c == text_col
          else F.col("row")[c].alias(c) for c in rest.columns],
        F.coalesce("cut", F.array().cast("array<int>")).alias("dropped"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line dedup of the whole ``documents`` table: per document the lines cut and the digest of what is left."""
    out = line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.size("dropped").alias("n_dropped"), "dropped",
                      F.char_length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))
