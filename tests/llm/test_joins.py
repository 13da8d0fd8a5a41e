"""Duplicate and leak search against brute force."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from fraudlens.llm import decontaminate, exact_dedup, line_dedup, ngram_join, queries, substring_dedup
from fraudlens.llm.components import components
from tests.conftest import SF_SMALL

ODD = [(1, None), (2, ""), (3, " \n"), (None, "a row without an id"), (4, "same same"), (4, "same same"), (5, "word " * 300)]


def words(n, seed):
    r = random.Random(seed)
    return [f"w{r.randrange(4000)}" for _ in range(n)]


def corpus():
    """Copies of a few texts with edits from none to many, and unrelated texts."""
    r = random.Random(5)
    out = []
    for g, size in enumerate((30, 60, 12, 150, 7, 4, 300)):
        base = words(size, g)
        for _ in range(40):
            own = list(base)
            for _ in range(r.choice((0, 0, 1, 1, 2, 3, 6))):
                own[r.randrange(len(own))] = f"n{r.randrange(50)}"
            out.append(" ".join(own))
    out += [" ".join(words(r.randrange(1, 80), 1000 + i)) for i in range(60)]
    r.shuffle(out)
    return list(enumerate(out))


def sql(name, docs):
    documents = docs.toArrow()  # noqa: F841
    return sorted(map(str, duckdb.sql(queries.ORACLES[name]).to_arrow_table().to_pylist()))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "x") for i, t in corpus()], "doc_id long, text string, key string").repartition(3)


def same(df, name, docs):
    got = df.toArrow().to_pylist()
    want = sql(name, docs)
    columns = list(got[0])
    keys = list(eval(want[0]))  # noqa: S307  column order of the SQL
    assert sorted(columns) == sorted(keys)
    assert sorted(str({k: r[k] for k in keys}) for r in got) == want


def test_ngram_join_has_every_link(docs):
    same(ngram_join.ngram_join(docs), "op2_ngram_join", docs)


def test_ngram_join_of_many_texts_that_are_alike(spark):
    """Variants of one text, most of them below the threshold to each other: large
    buckets whose members the sketches must tell apart without losing a link."""
    r, base, rows = random.Random(17), words(120, 77), []
    for i in range(60):
        own = [w if r.random() > 0.06 else f"v{i}x{j}" for j, w in enumerate(base)]
        for k in range(3):  # and near copies of each
            own = own[:]
            if k:
                own[r.randrange(len(own))] = f"c{i}y{k}"
            rows.append((1000 - len(rows) * 3, " ".join(own)))
    texts = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    same(ngram_join.ngram_join(texts), "op2_ngram_join", texts)


def test_sketches_differ_by_no_more_than_sets():
    r = random.Random(3)
    pool = words(400, 5)
    texts = [" ".join(r.sample(pool, r.choice((0, 3, 5, 40, 300))) + pool[: r.choice((0, 50, 400))]) for _ in range(40)]
    hashes, of = ngram_join.shingle_sets(texts, 5)
    sets = [set(hashes[of == i].tolist()) for i in range(len(texts))]
    rows = ngram_join.sketches(hashes, of, len(texts)).view(np.uint64)
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            apart = sum(int(w).bit_count() for w in rows[i] ^ rows[j])
            assert apart <= len(x ^ y)
            assert (apart == 0) or i != j


def test_substring_dedup_is_exact(docs):
    same(substring_dedup.substring_dedup(docs), "op1_substring_dedup", docs)
    # hot minimisers are split by window
    same(substring_dedup.substring_dedup(docs, split=3), "op1_substring_dedup", docs)


def test_substring_dedup_of_rows_without_own_ids(spark):
    passage, other = (" ".join(words(40, i)) for i in (901, 902))
    rows = [(1, "a " + passage), (None, "b c " + passage), (None, other), (2, other + " d"), (2, "e " + passage), (None, None), (3, " ".join(words(50, 903)))]
    found = substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in found)
    assert got == [(0, 0, 0), (0, 40, 40), (0, 42, 40), (1, 41, 40), (2, 41, 40), (2, 41, 40), (3, 50, 0)]


def test_exact_dedup(docs):
    def shaped(df):
        return df.select("doc_id", "keep_id", "group_size", "kept", F.sha2(F.lit(""), 256).alias("text_sha256"))

    want = [{k: v for k, v in eval(r).items() if k != "text_sha256"} for r in sql("op9_exact_dedup", docs)]  # noqa: S307
    for digest in (exact_dedup.sha256_bytes, lambda t: F.substring(F.md5(t), 1, 1).cast("binary")):  # a digest that collides
        got = [{k: r[k] for k in want[0]} for r in shaped(exact_dedup.exact_dedup(docs, digest=digest)).toArrow().to_pylist()]
        assert sorted(map(str, got)) == sorted(map(str, want))


def test_stream_state_goes_on(spark, tmp_dir):
    one = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    two = spark.createDataFrame([(3, "a"), (4, "c")], "doc_id long, text string")
    exact_dedup.exact_dedup(one, folder=tmp_dir + "/s").count()
    rows = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(two, folder=tmp_dir + "/s").collect()}
    assert rows == {1: (3, 2, False), 2: (2, 1, True), 3: (3, 2, True), 4: (4, 1, True)}


def test_odd_rows(spark):
    odd = spark.createDataFrame([(i, t, 1, "k", 0) for i, t in ODD], "doc_id long, text string, n int, key string, component int")
    assert len(ngram_join.ngram_join(odd).collect()) == len(ODD)
    assert len(exact_dedup.exact_dedup(odd).collect()) == len(ODD)
    plain = odd.where("doc_id <> 4")
    assert {r.doc_id: r.n_removed for r in substring_dedup.substring_dedup(plain).collect()} == {1: 0, 2: 0, 3: 0, 5: 300}
    lines = line_dedup.line_dedup(odd).collect()
    assert sum(r.kept for r in lines if r.doc_id in (1, 2, 3)) == 4
    for empty in (ngram_join.ngram_join, substring_dedup.substring_dedup, exact_dedup.exact_dedup, line_dedup.line_dedup):
        assert empty(odd.limit(0)).collect() == []
    assert decontaminate.decontaminate(odd, odd.select(F.lit(1).alias("item_id"), "text").limit(0)).collect() == []


def test_line_dedup_recall(spark):
    r = random.Random(9)
    rows = []
    for i in range(60):
        base = " ".join(words(30, i))
        rows += [base, base.replace("w1", "v1", 1), base + "!"]
    docs = spark.createDataFrame([(i, "\n".join(rows[i::20]) + "\n") for i in range(20)], "doc_id long, text string")
    got = {(x.doc_id, x.line_no): (x.keep_doc_id, x.keep_line_no) for x in line_dedup.line_dedup(docs).collect()}
    lines = {(i, k): x for i in range(20) for k, x in enumerate(rows[i::20])}
    sets = {k: line_dedup.shingles(x) for k, x in lines.items()}
    linked = [(a, b) for a in lines for b in lines if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    assert sum(got[a] == got[b] for a, b in linked) >= 0.98 * len(linked) > 0
    assert len({got[k] for k in lines}) >= 55
    back = line_dedup.without_duplicate_lines(docs, line_dedup.line_dedup(docs))
    assert back.count() == 20


def test_short_lines_meet_as_often_as_long_ones():
    r = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz "
    for n in (5, 10, 15, 20, 35, 100):  # shingles; of the second line four fifths, so the similarity is 0.8
        lines = ["".join(r.choices(letters, k=n + line_dedup.SHINGLE - 1)) for _ in range(1500)]
        a = line_dedup.band_keys(line_dedup.signatures(lines))
        b = line_dedup.band_keys(line_dedup.signatures([x[: -(n // 5)] for x in lines]))
        assert (a == b).any(axis=1).mean() >= 0.99, n
        assert (a == np.roll(b, 1, axis=0)).any(axis=1).mean() < 0.01
    # equal shingles have equal minima wherever a line stands
    lines = ["x" * k for k in (1, 7, 8, 9, 40_000)] + ["abcdefgh" * 9000, "tail line of it"]
    together = line_dedup.signatures(lines)
    assert all((line_dedup.signatures([x])[0] == together[i]).all() for i, x in enumerate(lines))


def test_line_prefixes_lose_no_link(spark, monkeypatch):
    r = random.Random(4)
    base = " ".join(words(14, 3))
    lines = [base]
    while len(lines) < 80:  # chains of small changes, many near the threshold
        x = r.choice(lines[-12:])
        k = r.randrange(len(x))
        lines.append(x[:k] + r.choice("qxz") + x[k + 1 :])
    lines = list(dict.fromkeys(lines)) + ["short", "x"]
    table = spark.createDataFrame([(bytes([i]), bytes([i]), x) for i, x in enumerate(lines)], "member binary, component binary, line string")
    sets = [line_dedup.shingles(x) for x in lines]
    want = {(a, b) for a in range(len(lines)) for b in range(a + 1, len(lines)) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}
    for hot in (line_dedup.HOT, 5):  # frequent shingles in one part and in several
        monkeypatch.setattr(line_dedup, "HOT", hot)
        got = {(x.a[0], x.b[0]) for x in line_dedup.prefix_pairs(table).collect()}
        assert want <= got and 0 < len(want) < len(lines) ** 2 // 4


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(1, 9), (9, 5), (7, 7)]
    found = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {**{i: 100 for i in range(100, 141)}, 1: 1, 9: 1, 5: 1}


def test_leaks_with_other_numbers_and_names(spark):
    item = "A train leaves Boston at 60 km and Maria pays 25 dollars; how far does Maria go in 60 minutes, and why does the train stop early?"
    moved = item.replace("Boston", "Lisbon").replace("Maria", "Peter").replace("60", "85").replace("25", "31")
    mixed = item.replace("pays 25", "pays 60").replace("go in 60", "go in 13").replace("does Maria", "does Peter")
    rows = [(1, "Before. " + item + " After."), (2, moved), (3, item.lower()), (4, "A train leaves Boston and nothing else happens here today"), (5, mixed), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(9, item), (8, None), (7, "the")], "item_id long, text string")
    found = {r.doc_id: (r.item_id, r.changed) for r in decontaminate.decontaminate(docs, items).collect()}
    assert found == {1: (9, False), 2: (9, True), 3: (9, False)}


def test_leaks_with_a_conflict_in_a_slot(spark):
    train = "A train leaves Boston at 60 and Maria pays 25 dollars; how far does Maria go in 60 and why does the train stop early?"
    fruit = "He has 3 apples and 3 oranges, how many fruits does he have?"
    story = " ".join(words(200, 1)).replace("w", "q")
    quoted = " ".join(story.split()[40:56])
    rows = [
        (1, train.replace("in 60", "in 13")), (2, train.replace("does Maria", "does Peter")), (3, fruit.replace("3 a", "5 a").replace("3 o", "7 o")),
        (4, train.replace("25", "60")), (5, "so it was " + quoted + " and then"), (6, "so it was " + " ".join(quoted.split()[:9]) + " and then"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, train), (2, fruit), (3, story)], "item_id long, text string")
    found = {r.doc_id: (r.item_id, r.changed) for r in decontaminate.decontaminate(docs, items).collect()}
    assert found == {1: (1, True), 2: (1, True), 3: (2, True), 4: (1, True), 5: (3, False)}


def test_leaks_of_numbers_and_scripts_without_blanks(spark):
    texts = {1: "12 + 7 * 5 - 3 = ?", 2: "2, 3, 5, 7, 11, 13, 17", 3: "一列火车以每小时60公里的速度离开北京，什么时候到达上海？", 4: "รถไฟออกจากกรุงเทพตอนเช้า", 5: "電車は何時に東京を出ますか。", 6: "1,2,3,4,5,6"}
    rows = [(i, f"before {t} after") for i, t in texts.items()] + [(20, "12 + 7 * 9 - 3 = ?"), (21, "火车很快"), (22, "2, 3, 5, 8, 13, 21")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([*texts.items(), (7, "too few words"), (8, None)], "item_id long, text string")
    with pytest.warns(UserWarning, match="2 benchmark items"):
        found = decontaminate.decontaminate(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(i, i) for i in texts}


def test_pipeline_stages(spark):
    import corpus_pipeline

    names = {}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    before = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, SF_SMALL), "stage")
        names[name] = docs.count()
        if name != "encoding":
            assert docs.columns == before
    assert list(names.values()) == sorted(names.values(), reverse=True) and names["encoding"] > 100
