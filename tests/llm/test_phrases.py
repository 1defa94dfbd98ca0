"""Phrase mining against plain counting."""

import random
import re
from collections import Counter

from occuspark.llm import phrases

COLUMNS = "doc_id long, text string, lang string, gid int, phrase string, chunk string"


def plain(rows, longest=3, least=10, most=2000):
    f, n = {}, Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    key = (lang, tuple(words[i:i + k]))
                    f[key] = f.get(key, 0) + 1
    cand = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    inside = {}
    for (lang, ws), a in cand.items():
        for m in range(2, len(ws)):
            for i in range(len(ws) - m + 1):
                key = (lang, ws[i:i + m])
                inside[key] = max(inside.get(key, 0), a)
    out = {}
    for (lang, ws), a in cand.items():
        if 100 * inside.get((lang, ws), 0) >= 50 * a and (lang, ws) in inside:
            continue
        score, _, l, r = min((1_000_000 * a * a // (f[lang, ws[:j]] * f[lang, ws[j:]]), j, f[lang, ws[:j]],
                              f[lang, ws[j:]]) for j in range(1, len(ws)))
        out.setdefault(lang, []).append((-score, -a, " ".join(ws).encode(), l, r))
    return sorted((lang, k + 1, p.decode(), -a, l, r, n[lang], -s) for lang, found in out.items()
                  for k, (s, a, p, l, r) in enumerate(sorted(found)[:most]))


def rows_of(seed, docs=300):
    rng = random.Random(seed)
    words = ["The", "the", "a", "b", "a|b", "\u00c9t\u00e9", "\u00e9t\u00e9", "x\u00a0y", "zz", "Q"]
    gaps = [" ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "! ", "\r\n"]
    rows = []
    for i in range(docs):
        text = "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randrange(40)))
        rows.append((i, text, rng.choice(["en", "en", "en", "de", None, "und"]), 1, "p", "c"))
    rows += [(1, None, "en", 1, "p", "c"), (1, "", "fr", 1, "p", "c"), (None, " . ", None, None, None, None)]
    rows += [(5, "New York City hall. " * 30, "en", 1, "p", "c")] * 4  # repeated rows
    return rows + [(9, "b " * 30_000, "long", 1, "p", "c")]


def test_equals_plain_counting_in_small_chunks_and_large(spark):
    rows = rows_of(3)
    docs = spark.createDataFrame(rows, COLUMNS).repartition(5)
    key = lambda r: (r["lang"], r["rank"])
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    for options in ({"chunk_words": 150, "shard_words": 700}, {}):
        got = [tuple(r[c] for c in names) for r in sorted(phrases.collocations(docs, **options).collect(), key=key)]
        assert got == plain(rows)


def test_longer_phrases_and_a_short_list(spark):
    rows = rows_of(4)
    docs = spark.createDataFrame(rows, COLUMNS)
    got = phrases.collocations(docs, longest=5, least=4, most=15, chunk_words=400).collect()
    assert sorted(map(tuple, got)) == plain(rows, 5, 4, 15)


def test_products_over_64_bits(spark):
    wide = spark.sql("SELECT CAST(4000000000 AS decimal(18,0)) AS a, CAST(7000000001 AS decimal(18,0)) AS l")
    got = wide.selectExpr("(CAST(1000000 AS decimal(7,0)) * (a * a)) div (l * l) AS s").head().s
    assert got == 1_000_000 * 4_000_000_000 ** 2 // 7_000_000_001 ** 2


def test_empty_table_and_empty_texts(spark):
    assert phrases.collocations(spark.createDataFrame([], COLUMNS)).collect() == []
    assert phrases.collocations(spark.createDataFrame([(1, None, "en", 1, "p", "c"), (2, " ,", "en", 1, "p", "c")],
                                                      COLUMNS)).collect() == []
