"""URL rules, phrases and spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fraudlens.llm import common, ngram_join, phrases, spelling, url_filter

RULES = [("com", "/", "allow"), ("Example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
         ("a.b.c", "/x", "block"), ("c", "/xyz", "allow"), ("c", "", "block"), ("net", "/es/", "allow"), ("co", "", "block")]
URLS = [None, "", "no scheme.com/en/", "://", "http://", "http://EXAMPLE.com/en/1?q=/es/", "https://www.example.com/en/2#t", "http://m.www.example.com/en/",
        "http://myexample.com/en/", "http://x.net/es/", "http://net/es/a", "http://net/es", "http://x.net?/es/", "http://b.c/xyz", "http://a.b.c/xyz", "http://a.b.c",
        "http://a.b.c/xy", "x://y://z.com/p", "http://.com/", "http://com./", "http://a..com/é/ü", "HTTP://É.COM/", "a\nb://x.com/\nq", "http://example.com/en",
        "http://x.co", "http://" + "a." * 3000 + "com/" + "p" * 100_000]


def judged(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:cut].translate(str.maketrans(url_filter.UPPER, url_filter.LOWER)), rest[cut:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    best = None
    for h, p, v in rules:
        h = h.lower()
        if host and ("." + host).endswith("." + h) and path.startswith(p):
            best = max(best or (), (len(h) + len(p), len(h), v, h + p))
    return host, path, best[3] if best else None, best[2] if best else default


def test_urls_are_judged_as_by_every_rule(spark):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    rows = [(i, u, "x", "y") for i, u in enumerate(URLS)] + [(None, URLS[5], "x", "y"), (7, URLS[7], "x", "y"), (7, URLS[7], "x", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, block string").repartition(3)
    got = sorted(url_filter.url_filter(pages, rules).toArrow().to_pylist(), key=str)
    want = [dict(zip(("page_id", "host", "path", "rule", "verdict"), (i, *judged(u, RULES)), strict=True)) for i, u, _, _ in rows]
    assert got == sorted(want, key=str)


def test_a_long_list_passes_few_others_and_loses_none(spark, monkeypatch):
    """Thousands of listed URLs, the blocks and the list joined by a shuffle too."""
    rules = spark.range(20_000).select(
        F.concat(F.lit("h"), F.col("id") % 5000, F.lit(".org")).alias("host"), F.concat(F.lit("/p"), F.col("id"), F.lit("/")).alias("path"),
        F.lit("block").alias("verdict"))
    pages = spark.range(40_000).select(
        F.col("id").alias("page_id"), F.concat(F.lit("http://www.h"), F.col("id") % 5000, F.lit(".org/p"), F.col("id"), F.lit("/t?q")).alias("url"))
    listed = url_filter.canonical_rules(rules)
    urls = pages.select(url_filter.host_of(F.col("url")).alias("host"), url_filter.path_of(F.col("url")).alias("path"))
    shapes = [tuple(r) for r in listed.select(url_filter._labels(F.col("rule_host")), F.length("rule_path")).distinct().collect()]
    keys = url_filter.keys_of(urls, shapes)
    hits = url_filter.possible_hits(keys, listed, 20_000)
    assert hits.join(listed, ["rule_host", "rule_path"]).count() == 20_000 and hits.count() < 20_000 + keys.count() / 500
    for limit in (url_filter.BROADCAST_BYTES, 0):
        monkeypatch.setattr(url_filter, "BROADCAST_BYTES", limit)
        out = url_filter.url_filter(pages, rules)
        assert out.where("verdict = 'block'").agg(F.count("*"), F.max("page_id"), F.count("rule")).first()[:] == (20_000, 19_999, 20_000)
        assert out.count() == 40_000


def test_urls_without_rules_or_rows(spark):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://x.com/")], "page_id long, url string")
    assert url_filter.url_filter(pages.limit(0), rules).count() == 0
    assert [tuple(r) for r in url_filter.url_filter(pages, rules.limit(0), "block").collect()] == [(1, "x.com", "/", None, "block")]


def counted(docs, least, top):
    """Phrases of each language by dictionaries."""
    total, f = Counter(), Counter()
    lower = str.maketrans(url_filter.UPPER, url_filter.LOWER)
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(ws)
            f.update((lang, *ws[i : i + k]) for k in range(1, 6) for i in range(len(ws) - k + 1))
    out = []
    for key, a in f.items():
        if len(key) < 3 or a < least:
            continue
        cuts = [(1000 * a * total[key[0]] // (f[key[:c]] * f[(key[0], *key[c:])]), c) for c in range(2, len(key))]
        score, c = min(cuts)
        out.append((key, a, f[key[:c]], f[(key[0], *key[c:])], score))
    gone = {
        (k[0], *k[i:j]) for k, a, *_ in out for i in range(1, len(k)) for j in range(i + 2, len(k) + 1)
        if j - i < len(k) - 1 and a >= f[(k[0], *k[i:j])]
    }
    rows = []
    for lang in total:
        own = sorted((-s, -a, " ".join(k[1:]).encode(), l, r) for k, a, l, r, s in out if k[0] == lang and k not in gone)
        rows += [(lang, i + 1, p.decode(), -a, l, r, total[lang], -s) for i, (s, a, p, l, r) in enumerate(own[:top])]
    return sorted(rows)


@pytest.mark.parametrize("small", [False, True])
def test_phrases_are_counted_as_by_dictionaries(spark, monkeypatch, small):
    r = random.Random(4)
    ws = [*"ABCDEFGH", "Été", "\x00", " x", "new", "York", " ", "'s"]
    docs = [(r.choice([None, "en", "und", "dé"]), "".join(r.choice(ws[: r.choice((4, 15))]) + r.choice([" ", " ", "  ", "\t", ". ", "\n", "\r\n", ",", "!"])
            for _ in range(r.randrange(60)))) for _ in range(120)] + [("en", None), ("en", ""), (None, " ,\n"), ("en", "big new york city " * 4000), ("en", "y" * 300_000)]
    if small:  # containers burst, tries spill, long texts are cut
        for name, value in (("BURST", 3), ("ENTRIES", 40), ("NUMBERED", 9), ("BATCH", 7), ("CHUNK", 50), ("PARTS", 2), ("PAIRS", 30)):
            monkeypatch.setattr(phrases, name, value)
        counter = phrases.Counter(np.full(phrases.BITMAP_BITS // 8, 255, np.uint8))
        runs = []
        for lang, text in docs:
            counter.add(lang or "und", (text or "").encode())
            runs += list(counter.room())
        assert len(runs) > 10
        runs += list(counter.spill(0))
        f = Counter()
        for b in runs:
            rows = list(zip(*(b.column(c).to_pylist() for c in ("lang", "phrase", "f")), strict=True))
            assert [p.encode() for _, p, _ in rows] == sorted(p.encode() for _, p, _ in rows)
            for lang, p, n in rows:
                f[lang, p] += n
        want = {(k, p): a for k, _, p, a, *_ in counted(docs, 1, 10**9)}
        assert all(f[k] == a for k, a in want.items()) and want
    df = spark.createDataFrame([(x, t, "p", 1) for x, t in docs], "lang string, text string, phrase string, n int").repartition(3)
    for least, top in ((5, 2000), (2, 9)):
        got = sorted(tuple(x) for x in phrases.phrases(df, least, top).collect())
        assert got == counted(docs, least, top)
        assert len(got) > 20
    assert phrases.phrases(df.limit(0)).count() == 0 and phrases.phrases(df, 10**6).count() == 0


@pytest.mark.parametrize("size", [1, 2, 7, 1000])
def test_runs_are_merged_across_batches(size):
    """Whole batches are added up at once: equal phrases over many batches, rare ones dropped last."""
    r = random.Random(size)
    rows = sorted((r.choice(["a", "a b", "a b c", "b", "é"]), r.choice(["de", "en"]), 1 + r.randrange(3)) for _ in range(60))
    batches = [pa.RecordBatch.from_arrays(
        [pa.array([x[1] for x in rows[i : i + size]]), pa.array([x[0] for x in rows[i : i + size]]),
         pa.array([len(x[0].split()) for x in rows[i : i + size]], pa.int32()), pa.array([x[2] for x in rows[i : i + size]], pa.int64())],
        names=["lang", "phrase", "words", "f"]) for i in range(0, len(rows), size)]
    want = Counter()
    for phrase, lang, n in rows:
        want[lang, phrase, len(phrase.split())] += n
    for least in (1, 12, 10**6):
        got = [tuple(x.values()) for b in phrases._merged(iter(batches), least) for x in b.to_pylist()]
        assert sorted(got) == sorted((*k, n) for k, n in want.items() if n >= least)
    assert list(phrases._merged(iter([]))) == [] == list(phrases._merged(iter([batches[0].slice(0, 0)])))


def test_scores_pass_64_bits(spark):
    big = 3 * 10**15
    counts = spark.createDataFrame([("en", "a", 1, big + 1), ("en", "b", 1, big + 7), ("en", "a b", 2, big)], "lang string, phrase string, words int, f long")
    got = phrases.scored(counts, spark.createDataFrame([("en", 10**18)], "lang string, n long")).first()
    assert got.score == 1000 * big * 10**18 // ((big + 1) * (big + 7))


def edits(w, letters):
    return {w[:i] + c + w[j:] for i in range(len(w) + 1) for j in (i, i + 1) if j <= len(w) for c in ["", *letters]} - {w}


def variants(docs, chars, least, ratio):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans(url_filter.UPPER, url_filter.LOWER))
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= chars and c >= least}
    letters = sorted(set("".join(n)))
    out = {}
    for w in n:
        near = edits(w, letters) & n.keys()
        best = min(near, key=lambda v: (-n[v], v), default=None)
        form = best if best and n[best] >= ratio * n[w] else None
        out[w] = [w, form, w, n[w], len(near), n[form] if form else None]
    for w, row in out.items():
        while out[row[2]][1]:
            row[2] = out[row[2]][1]
    return sorted(map(tuple, out.values()), key=str)


@pytest.mark.parametrize("most,chunk", [(10_000, 20_000), (25, 60)])
def test_spelling_variants_are_those_of_all_edits(spark, monkeypatch, most, chunk):
    monkeypatch.setattr(spelling, "CHUNK", chunk)
    monkeypatch.setattr(spelling.buckets, "__defaults__", (most,))
    r = random.Random(9)
    stems = ["connect", "Connécte", "connection", "abababab", "aaaaaaaa", "Àÿ×÷abcd", "internationalisation"]
    docs = []
    for i in range(400):
        found = []
        for _ in range(r.randrange(40)):
            w = r.choice(stems[: 2 if i % 3 else 7])
            for _ in range(r.choice((0, 0, 0, 1, 1, 2))):
                k = r.randrange(len(w))
                w = w[:k] + r.choice(["", "a", "b", "e", "é", "ab"]) + w[k + r.choice((0, 1)) :]
            found.append(w)
        docs.append((i, r.choice([" ", "-", "1", "\n"]).join(found)))
    docs += [(None, "connect connect connexion connexion"), (5, None), (6, ""), (7, "z" * 3000), (8, "z" * 3000), (9, "z" * 2999 + "y"), (9, "z" * 2999 + "y"), (3, docs[3][1])]
    df = spark.createDataFrame([(i, t, "w", 1) for i, t in docs], "doc_id long, text string, word string, n int").repartition(3)
    want = variants(docs, 7, 2, 10)
    got = sorted((tuple(x) for x in spelling.spelling(df).collect()), key=str)
    assert got == want
    assert sum(x[1] is not None for x in want) > 20 and sum(x[1] != x[2] and x[1] is not None for x in want) > 0
    if most > 25:
        assert spelling.spelling(df.limit(0)).count() == 0
    else:
        full = spelling.buckets(spelling.words(df), 7).groupBy("bucket").count().agg(F.max("count")).first()[0]
        assert full <= 25 or full <= 90 + 8100


def test_the_index_finds_what_a_scan_finds():
    r = random.Random(2)
    vocabulary = sorted({"".join(r.choice("abc") for _ in range(r.choice((7, 8, 9)))) for _ in range(900)})
    for side in ("first", "last"):
        found = {(a, b) for a, _, b, _ in spelling._search(side, [(w, 1, len(w)) for w in vocabulary])}
        for w in vocabulary[::7]:
            half = len(w) // 2
            fixed = (lambda v, w=w, half=half: v.startswith(w[:half])) if side == "first" else (lambda v, w=w, half=half: v.endswith(w[half:]))
            want = {v for v in edits(w, "abc") & set(vocabulary) if len(v) >= len(w) and fixed(v)}
            assert want <= {b for a, b in found if a == w} <= edits(w, "abc")


def test_workers_give_memory_back_at_the_end_of_a_task(spark, monkeypatch):
    """Once for each task, after its last batch, by every Arrow function of the pipeline."""
    given = []
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": ["a b"]})

    class Rows:
        sparkSession = spark

        def mapInArrow(self, run, schema):
            return list(run(iter([batch, batch])))

    for module in (common, ngram_join):
        monkeypatch.setattr(module, "release_unused", lambda: given.append(1))
    assert len(common.map_slices(Rows(), lambda b: {"doc_id": b.column("doc_id")}, "doc_id long")) == 2 and len(given) == 1
    assert list(ngram_join._verify(5)(iter([]))) == [] and len(given) == 2
