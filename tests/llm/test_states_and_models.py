from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from fraudlens.llm import exact_dedup, toxicity

DOCS = "doc_id long, text string"


def _colliding(text):
    """A digest of the first character only."""
    return F.substring(text, 1, 1).cast("binary")


def test_bytes_are_compared_across_calls(spark, tmp_dir):
    texts = ["aa", "ab", "a", "ba", "bb", "", None, "c" * 100_000]
    rows = [(i, texts[i * 7 % len(texts)]) for i in range(40)]
    first, second = rows[:20], rows[20:] + [(None, "aa"), (3, rows[3][1])]
    exact_dedup.exact_dedup(spark.createDataFrame(first, DOCS), tmp_dir, _colliding)
    got = exact_dedup.exact_dedup(spark.createDataFrame(second, DOCS), tmp_dir, _colliding).collect()
    groups = defaultdict(list)
    for i, t in first + second:
        groups[t or ""].append(i)
    assert len(got) == 42 and sum(r.kept for r in got) == len(groups)
    text_of = dict(rows)
    for r in got:
        own = groups["aa" if r.doc_id is None else text_of[r.doc_id] or ""]
        assert (r.group_size, r.keep_id) == (len(own), max(i for i in own if i is not None))
    assert exact_dedup.exact_dedup(spark.createDataFrame([], DOCS), tmp_dir, _colliding).count() == 42


def test_a_locator_leads_to_the_text(spark, tmp_dir):
    rows = [(i, f"text {i % 3}") for i in range(9)]
    got = exact_dedup.exact_dedup(spark.createDataFrame(rows, DOCS), tmp_dir)
    landed = spark.read.parquet(f"{tmp_dir}/landed").select("locator", "text")
    assert sorted((r.doc_id, r.text) for r in got.join(landed, "locator").collect()) == rows


def _labelled(spark, n):
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    return docs, docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))


def test_labels_without_a_document_take_no_share(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_ROWS", 50)
    docs, labels = _labelled(spark, 2000)
    more = spark.range(10**6, 10**6 + 200_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    drawn = toxicity.labelled_sample(docs, labels.unionByName(more), "toxic").groupBy("target").count().collect()
    assert all(25 <= r["count"] <= 62 for r in drawn) and len(drawn) == 2


def test_a_class_of_too_long_texts_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_CHARS", 50)
    docs, labels = _labelled(spark, 100)
    long = docs.withColumn("text", F.when(F.col("doc_id") % 4 == 0, F.repeat("text", 20)).otherwise(F.col("text")))
    with pytest.raises(ValueError, match="labelled 1 has more than 50"):
        toxicity.labelled_sample(long, labels, "toxic")


def test_the_bytes_of_a_sample_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 100_000)
    docs, labels = _labelled(spark, 4000)
    wide = docs.withColumn("text", F.repeat("text", 100))
    drawn = toxicity.labelled_sample(wide, labels, "toxic").groupBy("target").agg(F.sum(F.octet_length("text")).alias("b")).collect()
    assert all(50_000 <= r.b <= 150_000 for r in drawn) and len(drawn) == 2


def _small_model(seed=3):
    random = np.random.default_rng(seed)
    table = random.normal(0, 1, (3 * toxicity.BUCKETS, toxicity.SIZE)).astype(np.float32)
    filters = {w: random.normal(0, 1, (w * toxicity.SIZE, toxicity.FILTERS)).astype(np.float32) for w in toxicity.WIDTHS}
    bias = random.normal(0, 1, len(toxicity.WIDTHS) * toxicity.FILTERS).astype(np.float32)
    return toxicity.Model(table, filters, bias)


@pytest.mark.parametrize("block", [3, 7, 100_000])
def test_pools_are_those_of_every_window(monkeypatch, block):
    monkeypatch.setattr(toxicity, "BLOCK", block)
    texts = ["", "one", "one two", "a b c d e f g h i j k", "!!", "x y z", "the same the same the same"]
    model = _small_model()
    rows, _, text = toxicity.word_rows(texts)
    got = model.pooled(rows, text, len(texts))
    for i in range(len(texts)):
        vectors = [model.table[r].sum(axis=0) for r in rows[text == i]]
        for k, w in enumerate(toxicity.WIDTHS):
            at = slice(k * toxicity.FILTERS, (k + 1) * toxicity.FILTERS)
            windows = [np.concatenate(vectors[j : j + w]) @ model.filters[w] + model.bias[at] for j in range(len(vectors) - w + 1)]
            assert np.allclose(got[i, at], np.maximum(0, np.max(windows, axis=0)) if windows else 0, atol=1e-3)


def test_each_language_has_a_threshold_of_its_own():
    random = np.random.default_rng(5)
    function, plain = toxicity.FUNCTION_WORDS, [f"word{i}" for i in range(200)]
    texts, toxic = [], []
    for lang in function:
        for i in range(160):
            words = list(random.choice(function[lang].split(), 6)) + list(random.choice(plain, 10))
            # a word that is bad in one language is common in another
            bad = i % 4 == 0
            if bad or (lang == "de" and i % 2):
                words.append("villain")
            if bad:
                words.append("scoundrel" if lang != "de" else "schurke")
            texts.append(" ".join(random.permutation(words)))
            toxic.append(int(bad))
    toxic = np.array(toxic)
    left_out = np.arange(len(texts)) % 3 == 0
    model = toxicity.fit(texts, toxic, left_out)
    assert len(set(model.thresholds[: len(function)].tolist())) == len(function)
    found = model.scores(texts) >= 0.5
    for k in range(len(function)):
        own = np.arange(len(texts)) // 160 == k
        assert ((found == toxic)[own & left_out]).mean() >= 0.95
