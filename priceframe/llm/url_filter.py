"""Operator 7: URL filters by rules, then host word segmentation and multinomial naive Bayes.

A url's host and path are matched against rules first; the longest fitting rule
decides.  All others are judged by naive Bayes over the words of the host, cut
out of concatenated names by a unigram Viterbi, and of the path.

Models, both from all pages: the unigram lexicon counts the words of the page
texts and the parts of host names; naive Bayes counts the words of urls, a
url being a block example if its segmented host has a seed word.  Host words are
counted over distinct hosts so that a host with a third of all pages is one
example; paths are counted per page.

Scale: counts are partial aggregates.  The lexicon is whole: each distinct host
part is joined with the words among its substrings and cut once.  Naive Bayes
hashes words into ``BUCKETS`` slots.  Judging joins the hosts' words to the scan,
broadcast where their files are small.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators._util import broadcast_if_small
from .common import materialize, pick, table

#: (host, path, verdict)
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))
#: Words that mark a host as a block example.
SEEDS = ("ads", "adult", "bet", "bets", "betting", "casino", "cheap", "clickbait", "escort", "gamble", "gambling",
         "jackpot", "loan", "loans", "malware", "payday", "phishing", "pill", "pills", "poker", "porn", "scam", "sex",
         "slots", "spam", "track", "tracker", "tracking", "viagra", "warez", "xxx")
LEXICON = 1 << 16       #: words that ``lexicon`` returns at most; the query uses all words
BUCKETS = 1 << 18       #: slots of the naive Bayes counts
LONGEST = 24            #: letters of the longest word a segment can be
SMOOTH = 0.1            #: added to each count of naive Bayes
SEED = 7
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url):
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url):
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host, path, rules=RULES):
    """(rule as text, its verdict) of the longest rule that fits, null without one; the first of equally long ones."""
    name = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(reversed(rules), key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


class Segmenter:
    """Unigram Viterbi over word costs; a word outside the lexicon costs more the longer it is."""

    def __init__(self, cost: dict[str, float], unknown: float, longest: int = LONGEST):
        self.cost, self.unknown, self.longest = cost, unknown, longest
        self.split = lru_cache(maxsize=1 << 18)(self._split)

    @classmethod
    def of_counts(cls, counts: dict[str, int]) -> Segmenter:
        total = sum(counts.values()) or 1
        return cls({w: math.log(total / c) for w, c in counts.items()}, math.log(total))

    def _word(self, w: str) -> float:
        known = self.cost.get(w)
        return known if known is not None else self.unknown + 2.3 * len(w)

    def _split(self, text: str) -> tuple[str, ...]:
        """The cheapest words of a name; of equally cheap ends the longest last word."""
        best, back = [0.0], [0]
        for end in range(1, len(text) + 1):
            cost, at = min((best[start] + self._word(text[start:end]), start)
                           for start in range(max(0, end - self.longest), end))
            best.append(cost)
            back.append(at)
        words, end = [], len(text)
        while end:
            words.append(text[back[end]:end])
            end = back[end]
        return tuple(reversed(words))


_PARTS = re.compile(r"[a-z]+")
_FOLD = str.maketrans(_UPPER, _LOWER)
HOST, PATH = 0, 1       #: the two kinds of words, each a multinomial of its own


def host_words(host: str, segment: Segmenter) -> list[str]:
    return [w for part in _PARTS.findall(host) for w in segment.split(part)]


def path_words(path: str) -> list[str]:
    return _PARTS.findall(path.translate(_FOLD))


def slot(word: str) -> int:
    return xxhash.xxh64_intdigest(word, SEED) % BUCKETS


def word_counts(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(w, n)`` of all words of all pages' texts and host parts, a host part once per distinct host."""
    text = F.regexp_replace(F.coalesce(pick(html_col).cast("string"), F.lit("")), r"<[^>]*>", " ")
    words = pages.select(F.explode(F.split(F.lower(text), r"[^a-z]+")).alias("w"))
    hosts = pages.select(host_of(pick(url_col).cast("string")).alias("h")).distinct()
    parts = hosts.select(F.explode(F.split("h", r"[^a-z]+")).alias("w"))
    return (words.unionByName(parts).where((F.char_length("w") > 1) & (F.char_length("w") <= LONGEST))
            .groupBy("w").agg(F.count("*").alias("n")))


def lexicon(pages: DataFrame, url_col: str = "url", html_col: str = "html", size: int = LEXICON,
            seeds: tuple[str, ...] = SEEDS) -> dict[str, int]:
    """Counts of the most frequent words of all pages' texts and host parts; every seed is in it.

    A host part counts once per distinct host.  Words are taken by classes of
    like counts (an eighth of a power of two wide), most frequent first, while all
    of a class still fit ``size``: no sort, and at most ``size`` words reach the driver.
    """
    counts = word_counts(pages, url_col, html_col).withColumn("k", F.floor(F.log2("n") * 8))
    counts = materialize(counts, "lexicon")
    least, room = None, size
    for r in counts.groupBy("k").agg(F.count("*").alias("m")).orderBy(F.desc("k")).collect():  # 512 classes at most
        room -= r["m"]
        if room < 0:
            break
        least = r["k"]
    got = {} if least is None else {r["w"]: r["n"] for r in counts.where(F.col("k") >= least).collect()}
    typical = max(1, sum(got.values()) // max(1, len(got)))
    return got | {s: max(typical, got.get(s, 0)) for s in seeds}


def host_segments(pages: DataFrame, url_col: str = "url", html_col: str = "html",
                  seeds: tuple[str, ...] = SEEDS) -> DataFrame:
    """``(host, words)`` of every distinct host, cut by the counts of all words; every seed counts as a typical word at least.

    Each distinct host part meets the words among its substrings, and only these, in a join.
    """
    spark = pages.sparkSession
    counts = materialize(word_counts(pages, url_col, html_col), "lexicon")
    size = counts.agg(F.count("*").alias("words"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    typical = max(1, size["n"] // max(1, size["words"]))
    is_seed = F.col("w").isin(*seeds)
    known = {r["w"]: r["n"] for r in counts.where(is_seed).collect()}
    raised = {s: max(typical, known.get(s, 0)) for s in seeds}
    total = (size["n"] - sum(known.values()) + sum(raised.values())) or 1
    words = counts.where(~is_seed).unionByName(spark.createDataFrame(list(raised.items()), "w string, n long"))

    hosts = materialize(pages.select(host_of(pick(url_col).cast("string")).alias("host")).distinct(), "url-hosts")
    parts = hosts.select("host", F.posexplode(F.regexp_extract_all("host", F.lit("([a-z]+)"), F.lit(1))).alias("at", "part"))
    names = materialize(parts.select("part").distinct(), "url-parts")
    cuts = (names.where(F.char_length("part") > 1)
            .select("part", F.explode(F.sequence(F.lit(1), F.char_length("part") - 1)).alias("start"))
            .select("part", F.explode(F.transform(
                F.sequence(F.lit(2), F.least(F.lit(LONGEST), F.char_length("part") - F.col("start") + 1)),
                lambda z: F.substring(F.col("part"), F.col("start"), z))).alias("w")).distinct())
    # The planner does not see how many substrings there are: never a broadcast.
    found = cuts.hint("merge").join(words, "w").groupBy("part").agg(F.collect_list(F.struct("w", "n")).alias("k"))

    def run(batches):
        for pdf in batches:
            out = []
            for part, ws, ns in zip(pdf["part"], pdf["ws"], pdf["ns"], strict=True):
                own = {} if ws is None else {w: math.log(total / n) for w, n in zip(ws, ns, strict=True)}
                out.append(list(Segmenter(own, math.log(total))._split(part)))
            yield pd.DataFrame({"part": pdf["part"], "ws": out})

    split = names.join(found, "part", "left").select("part", F.col("k.w").alias("ws"), F.col("k.n").alias("ns")) \
        .mapInPandas(run, "part string, ws array<string>")
    of = parts.join(broadcast_if_small(split), "part").groupBy("host").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "ws"))), lambda x: x["ws"])).alias("words"))
    return materialize(hosts.join(of, "host", "left").select("host", F.coalesce(
        "words", F.array().cast("array<string>")).alias("words")), "url-segments")


def train(pages: DataFrame, segments: DataFrame, url_col: str = "url", seeds: tuple[str, ...] = SEEDS,
          smooth: float = SMOOTH) -> tuple[np.ndarray, float]:
    """(log-odds of block per kind and slot, log-odds of the classes), counted over all urls; ``segments`` has the hosts' words."""
    marks = set(seeds)
    url = pick(url_col).cast("string")

    def run(batches):
        for pdf in batches:
            sums: dict[tuple[int, int, int], int] = {}

            def add(kind, at, bad, n):
                sums[kind, at, bad] = sums.get((kind, at, bad), 0) + n

            for words, path, n in zip(pdf["words"], pdf["path"], pdf["n"], strict=True):
                bad = int(not marks.isdisjoint(words))
                if path is None:  # a distinct host
                    add(HOST, -1, bad, 1)
                    for w in words:
                        add(HOST, slot(w), bad, 1)
                else:
                    for w in path_words(path):
                        add(PATH, slot(w), bad, n)
            yield pd.DataFrame([(*k, n) for k, n in sums.items()], columns=["kind", "slot", "bad", "n"])

    urls = pages.select(host_of(url).alias("host"), path_of(url).alias("path"))
    paths = urls.groupBy("host", "path").agg(F.count("*").alias("n")).join(broadcast_if_small(segments), "host") \
        .select("words", "path", "n")
    hosts = segments.select("words", F.lit(None).cast("string").alias("path"), F.lit(1).cast("long").alias("n"))
    # At most 4 * BUCKETS + 2 rows come back.
    got = (paths.unionByName(hosts).mapInPandas(run, "kind int, slot long, bad int, n long")
           .groupBy("kind", "slot", "bad").agg(F.sum("n").alias("n")).collect())
    counts, classes = np.zeros((2, 2, BUCKETS)), [smooth, smooth]
    for r in got:
        if r["slot"] < 0:
            classes[r["bad"]] += r["n"]
        else:
            counts[r["kind"], r["bad"], r["slot"]] += r["n"]
    words = np.maximum(1, (counts.sum(axis=1) > 0).sum(axis=1))[:, None, None]
    share = np.log((counts + smooth) / (counts.sum(axis=2, keepdims=True) + smooth * words))
    unseen = counts.sum(axis=1) == 0  # a word of no url says nothing
    return np.where(unseen, 0.0, share[:, 1] - share[:, 0]), math.log(classes[1] / classes[0])


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rules=RULES,
          seeds: tuple[str, ...] = SEEDS) -> DataFrame:
    """``(page_id, host, path, rule, verdict, words, log_odds)`` per page.

    The verdict is the rule's where one fits, else block if naive Bayes finds
    block likelier; words are the host's segments, log_odds those of block.

    Defined cases: a null url or one without ``://`` has an empty host and path,
    fits no rule and has only the classes' odds; a null id stays null; repeated
    rows are each judged alike; an empty table gives no rows; other columns are
    not read; a host of many names is segmented in time linear in its length.
    """
    spark = pages.sparkSession
    segments = host_segments(pages, url_col, html_col, seeds)
    odds, prior = train(pages, segments, url_col, seeds)
    shared = spark.sparkContext.broadcast((odds, prior))

    def run(batches):
        odds, prior = shared.value
        for pdf in batches:
            pdf["log_odds"] = [prior + float(sum(odds[HOST, slot(w)] for w in ws)
                                             + sum(odds[PATH, slot(w)] for w in path_words(p)))
                               for ws, p in zip(pdf["words"], pdf["path"], strict=True)]
            yield pdf

    url = pick(url_col).cast("string")
    rows = pages.select(pick(id_col).cast("string").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.join(broadcast_if_small(segments), "host").select("page_id", "host", "path", "words")
    got = rows.mapInPandas(run, "page_id string, host string, path string, words array<string>, log_odds double")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    kind = pages.schema[id_col].dataType
    return got.select(F.col("page_id").cast(kind).alias("page_id"), "host", "path", rule.alias("rule"), F.coalesce(
        verdict, F.when(F.col("log_odds") > 0, "block").otherwise("allow")).alias("verdict"), "words", "log_odds")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on every url of the whole ``pages`` table."""
    return judge(table(spark, sf_dir, "pages"))
