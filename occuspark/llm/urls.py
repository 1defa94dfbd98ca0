"""URL verdicts: longest fitting rule, else naive Bayes over segmented host and path tokens.

1. Host and path are cut out by column expressions; rules (a host suffix and a
   path beginning) are tested there too.
2. A unigram Viterbi splits letter runs such as ``freebetsnow`` into words.  Its
   counts come from a seed list and from the parts of hyphenated names and path
   words of all urls, counted once per host.  Every word stays, in a Spark table:
   a run meets the counts of its own substrings in a join.
3. Multinomial naive Bayes: hosts that the seed words alone decide give token
   counts of both classes, so words that keep company with them are learned.
   Smoothing draws every token towards its share in all hosts; unseen tokens say
   nothing.  All tokens count, in a Spark table too, which urls meet in a join.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage

#: (host and path beginning, verdict)
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"),
         ("com/de/", "block"))
#: Words of unwanted sites, and of ordinary ones.
BLOCK_WORDS = ("casino", "bet", "bets", "betting", "poker", "slots", "jackpot", "gambling", "roulette", "lottery",
               "pill", "pills", "pharma", "viagra", "cialis", "adult", "xxx", "porn", "sex", "escort", "nude", "spam",
               "scam", "warez", "torrent", "payday", "loans", "replica", "ads", "adserver", "advert", "tracker",
               "tracking", "popup", "malware", "phish", "phishing")
ALLOW_WORDS = ("news", "wiki", "docs", "school", "university", "health", "library", "science", "research",
               "museum", "city", "journal", "book", "books", "music", "art", "food", "travel", "weather", "sport",
               "sports", "garden", "tech", "daily", "times", "press", "media", "forum", "history", "church", "college",
               "hospital", "society", "institute", "academy", "recipes", "family")
#: Further words that names are split into; they speak for neither side.
PLAIN_WORDS = ("blog", "the", "and", "for", "my", "web", "site", "online", "info", "page", "pages", "article", "story", "about",
               "local", "national", "public", "home", "house", "world", "open", "data", "code", "photo", "mail", "shop",
               "store", "help", "support", "learn", "team", "club", "green", "water", "river", "mountain", "kitchen",
               "free", "cheap", "win", "winner", "farm", "best", "top", "now", "bonus", "deal", "deals", "click",
               "track", "banner", "loan", "prize", "link", "links", "game", "games", "play", "live", "video", "buy",
               "sale", "money", "cash", "day", "night", "life", "love", "red", "blue", "example", "www", "com", "org",
               "net", "edu", "gov")
SEED_COUNT = 20
#: How many times likelier a listed word is in its own class, before any data.
BLOCK_TILT, ALLOW_TILT = 20.0, 5.0
TOKEN = re.compile(r"[a-z]+|[0-9]+")
RULE_COLUMNS = "rule string, rule_verdict string"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(F.regexp_extract(text, shape, 1), upper, lower), F.regexp_extract(text, shape, 2)


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null where none fits (ties: the first listed)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):  # later tests, of longer rules, win
        name, start = text.split("/", 1)
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + start)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


class Segmenter:
    """Unigram Viterbi: the split of a letter run into words of highest probability."""

    def __init__(self, counts: dict[str, int], longest: int = 24, total: int | None = None):
        self.total = max(1, sum(counts.values()) if total is None else total)
        self.cost = {w: -math.log(n / self.total) for w, n in counts.items() if n > 0}
        self.longest = longest
        self.seen: dict[str, list[str]] = {}

    def unknown(self, size: int) -> float:
        """An unseen word costs more the longer it is, and more than any seen one of its length."""
        return math.log(self.total) + 2.3 * size

    def split(self, run: str) -> list[str]:
        if run not in self.seen:
            if len(self.seen) > 50_000:
                self.seen.clear()
            self.seen[run] = self._split(run)
        return self.seen[run]

    def _split(self, run: str) -> list[str]:
        best, back = [0.0], [0]
        for end in range(1, len(run) + 1):
            options = []
            for start in range(max(0, end - self.longest), end):
                word = run[start:end]
                options.append((best[start] + self.cost.get(word, self.unknown(end - start)), start))
            cost, start = min(options)
            best.append(cost)
            back.append(start)
        words, end = [], len(run)
        while end:
            words.append(run[back[end]:end])
            end = back[end]
        return words[::-1]


def tokens(text: str, segmenter: Segmenter) -> list[str]:
    """Words of a host or path; a number is the token ``#``."""
    out: list[str] = []
    for t in TOKEN.findall(text.lower()):
        out += ["#"] if t[0].isdigit() else segmenter.split(t)
    return out


def plain_words(host: str, path: str) -> set[str]:
    """Words that are split already: parts of hyphenated names and of path slugs."""
    parts = [p for label in host.split(".") if "-" in label or "_" in label for p in re.split(r"[-_]", label)]
    parts += re.split(r"[^a-z]+", path.lower())
    return {p for p in parts if 1 < len(p) <= 20 and p.isascii() and p.isalpha()}


@dataclass
class UrlModel:
    words: dict[str, int] = field(default_factory=dict)
    log_odds: dict[str, float] = field(default_factory=dict)
    prior: float = -2.0

    def score(self, host: str, path: str, segmenter: Segmenter) -> float:
        """Log odds that the url is unwanted; tokens that no host showed count nothing."""
        found = tokens(host, segmenter) + tokens(path, segmenter)
        return self.prior + sum(self.log_odds.get(t, 0.0) for t in found)


@dataclass
class UrlTables:
    """The model as tables: ``words`` (word, n), ``splits`` (run, words) and ``odds`` (token, odds) of all hosts."""
    words: DataFrame
    splits: DataFrame
    odds: DataFrame
    prior: float


def keyed(urls: DataFrame) -> DataFrame:
    """``host, path`` rows with a short key of both and one of the host: tables of parts of urls carry these, so that
    they stay linear in a url's length."""
    size = F.length("host").cast("string")
    return urls.withColumns({"key": F.md5(F.concat_ws(":", size, "host", "path")), "host_key": F.md5("host")})


def word_counts(hosts: DataFrame) -> DataFrame:
    """``word, n``: hosts that show the word split already, and the seeds' share."""
    def words_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = {(k, w) for k, h, p in zip(b["host_key"], b["host"], b["path"], strict=True) for w in plain_words(h, p)}
            yield pd.DataFrame(list(rows), columns=["host", "word"])

    seeds = hosts.sparkSession.createDataFrame(
        [(w, SEED_COUNT) for w in dict.fromkeys(BLOCK_WORDS + ALLOW_WORDS + PLAIN_WORDS)], "word string, n long")
    rows = keyed(hosts).select("host_key", "host", "path")
    seen = rows.mapInPandas(words_of, "host string, word string").distinct().groupBy("word").agg(F.count("*").alias("n"))
    return seen.unionByName(seeds).groupBy("word").agg(F.sum("n").alias("n"))


def runs_of(urls: DataFrame) -> DataFrame:
    """``key, host_key, hosted, at, run, name``: letter runs and numbers of every distinct host and path, in order;
    ``name``: of the host; ``hosted``: the url has one."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["key", "host_key", "hosted", "at", "run", "name"]
        for b in batches:
            rows = []
            for k, hk, h, p in zip(b["key"], b["host_key"], b["host"], b["path"], strict=True):
                name, rest = TOKEN.findall(h.lower()), TOKEN.findall(p.lower())
                rows += [(k, hk, h != "", i, "#" if t[0].isdigit() else t, i < len(name)) for i, t in enumerate(name + rest)]
                if len(rows) > 200_000:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
            yield pd.DataFrame(rows, columns=columns)

    return keyed(urls.select("host", "path")).dropDuplicates(["key"]).select("key", "host_key", "host", "path").mapInPandas(
        run, "key string, host_key string, hosted boolean, at int, run string, name boolean")


def split_runs(runs: DataFrame, words: DataFrame, longest: int = 24) -> DataFrame:
    """``run, words`` of every distinct run, by the counts of all its substrings that are words."""
    total = words.agg(F.sum("n")).first()[0]

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows: set[tuple[str, str]] = set()
            for k, r in zip(b["run_key"], b["run"], strict=True):
                for i in range(len(r) if r != "#" else 0):
                    rows.update((k, r[i:j]) for j in range(i + 1, min(len(r), i + longest) + 1))
                    if len(rows) > 200_000:
                        yield pd.DataFrame(list(rows), columns=["run_key", "word"])
                        rows = set()
            yield pd.DataFrame(list(rows), columns=["run_key", "word"])

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"run": b["run"], "words": [
                ["#"] if r == "#" else Segmenter({} if w is None else dict(zip(w, n, strict=True)), longest, total).split(r)
                for r, w, n in zip(b["run"], b["words"], b["n"], strict=True)]})

    distinct = cut_lineage(runs.select("run").distinct().withColumn("run_key", F.md5("run")))
    known = (distinct.mapInPandas(pieces, "run_key string, word string").join(words, "word").groupBy("run_key")
             .agg(F.collect_set(F.struct("word", "n")).alias("k")).select("run_key", "k.word", "k.n"))
    return distinct.join(known, "run_key", "left").select("run", F.col("word").alias("words"), "n").mapInPandas(
        best, "run string, words array<string>")


def tables(urls: DataFrame, pull: float = 50.0) -> UrlTables:
    """Model from all ``host, path`` rows with a host; rows without one are split only.  Four numbers reach the driver."""
    words = cut_lineage(word_counts(urls.where("host <> ''")))
    runs = cut_lineage(runs_of(urls))
    splits = cut_lineage(split_runs(runs, words))
    found = (runs.where("hosted").select(F.col("host_key").alias("host"), "run", "name").distinct().join(splits, "run")
             .select("host", "name", F.explode("words").alias("token"))
             .groupBy("host", "token").agg(F.max("name").alias("name")))

    def listed(some: tuple) -> Column:
        return F.sum((F.col("name") & F.col("token").isin(*some)).cast("int"))

    # 1 where a host has unwanted seed words, no fewer than ordinary ones; else 0
    found = cut_lineage(found)
    sides = found.groupBy("host").agg(listed(BLOCK_WORDS).alias("bad"), listed(ALLOW_WORDS).alias("good")).select(
        "host", ((F.col("bad") > 0) & (F.col("bad") >= F.col("good"))).cast("int").alias("side"))
    sides = cut_lineage(sides)
    count = {r["side"]: r["n"] for r in sides.groupBy("side").agg(F.count("*").alias("n")).collect()}
    table = cut_lineage(found.join(sides, "host").groupBy("token").agg(F.sum("side").alias("block"),
                                                                       F.sum(1 - F.col("side")).alias("allow")))
    sums = table.agg(F.coalesce(F.sum("block"), F.lit(0)).alias("b"), F.coalesce(F.sum("allow"), F.lit(0)).alias("a")).first()
    n_block, n_allow = sums["b"], sums["a"]
    seeds = urls.sparkSession.createDataFrame([(w, 0, 0) for w in BLOCK_WORDS + ALLOW_WORDS], "token string, block long, allow long")
    table = table.unionByName(seeds).groupBy("token").agg(F.sum("block").alias("b"), F.sum("allow").alias("a"))
    tilt = F.when(F.col("token").isin(*BLOCK_WORDS), BLOCK_TILT).when(
        F.col("token").isin(*ALLOW_WORDS), 1 / ALLOW_TILT).otherwise(1.0)
    share = F.greatest(F.col("a") + F.col("b"), F.lit(1)) / F.lit(float(n_block + n_allow + 1))
    odds = (F.log((F.col("b") + pull * share * F.greatest(F.lit(1.0), tilt)) / F.lit(n_block + pull))
            - F.log((F.col("a") + pull * share * F.greatest(F.lit(1.0), 1 / tilt)) / F.lit(n_allow + pull)))
    prior = math.log((count.get(1, 0) + 1) / (count.get(0, 0) + 9))
    return UrlTables(words, splits, cut_lineage(table.select("token", odds.alias("odds"))), prior)


def fit(hosts: DataFrame) -> UrlModel:
    """The whole model of ``host, path`` rows in the driver's memory, for tables known to be small."""
    made = tables(hosts)
    return UrlModel({r["word"]: r["n"] for r in made.words.collect()},
                    {r["token"]: r["odds"] for r in made.odds.collect()}, made.prior)


def scores(urls: DataFrame, model: UrlTables) -> DataFrame:
    """``key, log_odds`` of every distinct host and path that has a token.  Summed in the url's order."""
    of_run = (model.splits.select("run", F.posexplode("words").alias("i", "token")).join(model.odds, "token")
              .groupBy("run").agg(F.array_sort(F.collect_list(F.struct("i", "odds"))).alias("o"))
              .select("run", F.col("o.odds").alias("odds")))
    return (runs_of(urls).join(of_run, "run").groupBy("key")
            .agg(F.flatten(F.array_sort(F.collect_list(F.struct("at", "odds"))).getField("odds")).alias("o"))
            .select("key", F.aggregate("o", F.lit(0.0), lambda x, y: x + y).alias("log_odds")))


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """``page_id, url, host, path, rule, verdict, score`` of every row.

    A rule's verdict stands; without one the url is blocked where its log odds are
    above 0.  A null url, one without ``://`` and one without known tokens have
    empty or neutral parts and are allowed by the prior.  Repeated rows are judged
    alike, hosts count once in the model however many pages they have.
    """
    host, path = split_url(F.col("url"))
    rows = pages.select(F.col("page_id"), F.col("url"), host.alias("host"), path.alias("path"))
    model = tables(rows)
    rule, said = rule_columns(F.col("host"), F.col("path"), rules)

    scored = keyed(rows).join(scores(rows, model), "key", "left").withColumn(
        "score", F.lit(model.prior) + F.coalesce("log_odds", F.lit(0.0)))
    verdict = F.coalesce(said, F.when(F.col("score") > 0, F.lit("block")).otherwise(F.lit("allow")))
    return scored.select("page_id", "url", "host", "path", rule.alias("rule"), verdict.alias("verdict"), "score")
