import json
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fraudlens.operators.position import with_position
from fraudlens.schemas import RAW_ORDER
from fraudlens.sources.json_array import read_json_array, write_json_arrays
from fraudlens.streaming.arrivals import ingest_open, open_hours, publish_arrivals, read_arrivals

NESTED = "a string, n long, o struct<x:string, p:struct<y:string>>, l array<struct<z:string>>"


@pytest.fixture()
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _schema(spark):
    return spark.createDataFrame([], NESTED).schema


def _objects(n, seed=1):
    r = random.Random(seed)
    texts = ["", "}", "{", '"', "\\", '\\"}', "a,b", "[{", "}]", "é 漢", "\n", "\\\\", '{"a": 1}']
    return [
        {
            "a": "".join(r.choices(texts, k=r.randint(0, 6))),
            "n": i,
            "o": r.choice([None, {"x": r.choice(texts), "p": {"y": r.choice(texts)}}]),
            "l": [{"z": r.choice(texts)} for _ in range(r.randint(0, 3))],
        }
        for i in range(n)
    ]


@pytest.mark.parametrize("style", [{}, {"indent": 2}, {"separators": (",", ":"), "ensure_ascii": False}])
def test_an_array_is_read_by_many_tasks(spark, tmp_dir, small_splits, style):
    objects = _objects(1500)
    for k in range(2):
        with open(f"{tmp_dir}/{k}.json", "w") as out:
            out.write(json.dumps(objects[k::2], **style))
    assert spark.read.option("lineSep", "}").text(tmp_dir).rdd.getNumPartitions() > 8
    got = read_json_array(spark, tmp_dir, _schema(spark))
    assert sorted((r.asDict(True) for r in got.collect()), key=lambda o: o["n"]) == objects


def test_arrays_that_are_odd(spark, tmp_dir):
    texts = {"empty": "", "none": "[]", "blank": " [ \n ]\n", "object": '{"a": "x}", "n": 1}', "bom": '﻿[{"a": "y", "n": 2}]'}
    for name, text in texts.items():
        with open(f"{tmp_dir}/{name}.json", "w") as out:
            out.write(text)
    got = read_json_array(spark, tmp_dir, _schema(spark)).select("a", "n").collect()
    assert sorted(map(tuple, got)) == [("x}", 1), ("y", 2)]


def test_a_file_cut_short_gives_a_row_of_nulls(spark, tmp_dir):
    with open(f"{tmp_dir}/cut.json", "w") as out:
        out.write('[{"a": "x", "n": 1}, {"a": "y", "n": {"deep": 2}')
    got = read_json_array(spark, tmp_dir, _schema(spark)).select("a", "n").collect()
    assert ("x", 1) in map(tuple, got) and len(got) == 2
    assert [tuple(r) for r in got if r.a != "x"][0][1] is None


def test_written_arrays_are_json_of_bounded_size(spark, tmp_dir):
    import glob

    df = spark.range(1000).select(F.col("id").alias("n"), F.when(F.col("id") % 7 > 0, F.concat(F.lit('}"{'), "id")).alias("a"))
    path = write_json_arrays(df, f"{tmp_dir}/arrays", rows_per_file=300)
    files = [json.load(open(f)) for f in glob.glob(f"{path}/*.txt")]
    assert len(files) == 4 and max(map(len, files)) <= 400
    assert sorted(o["n"] for f in files for o in f) == list(range(1000)) and "a" in files[0][0]
    assert sorted(map(tuple, read_json_array(spark, path, df.schema).collect())) == sorted(map(tuple, df.collect()))


def test_positions_follow_the_keys(spark):
    rows = spark.range(5000, numPartitions=7).select((F.col("id") * 7919 % 100).alias("k"), F.col("id").alias("v"))
    got = with_position(rows, F.desc("k"), F.asc("v")).orderBy("position").collect()
    assert [r.position for r in got] == list(range(1, 5001))
    assert [(r.k, r.v) for r in got] == sorted(((r.k, r.v) for r in rows.collect()), key=lambda x: (-x[0], x[1]))


def test_positions_of_ties_repeats_and_nothing(spark):
    ties = spark.range(4000, numPartitions=6).select(F.lit(1).alias("k"), F.when(F.col("id") < 10, F.lit(0)).alias("v"))
    got = with_position(ties, "k").collect()
    assert sorted(r.position for r in got) == list(range(1, 4001))
    assert with_position(ties.where("k = 2"), "k").collect() == []
    assert with_position(ties.where("k = 2"), "k").columns == ["k", "v", "position"]


def _events(spark, ids):
    rows = [(f"O{i}", f"U{i}", "P1", 1, "Rp.5", "Paylater", "ID", "2025-11-03T10:00:00" if i % 5 else "never") for i in ids]
    return spark.createDataFrame(rows, RAW_ORDER.fieldNames()).select(*[F.col(f.name).cast(f.dataType) for f in RAW_ORDER.fields])


def test_polls_read_open_hours_only(spark, tmp_dir):
    topic, ckpt = f"{tmp_dir}/topic", f"{tmp_dir}/ckpt"

    def poll(now, **kw):
        return ingest_open(spark, topic, f"{tmp_dir}/orders", ckpt, now, f"{tmp_dir}/rejects", grace_hours=1, **kw)

    def ids(which="orders"):
        return sorted(int(r.order_id[1:]) for r in read_arrivals(spark, ckpt, which).collect())

    assert poll(datetime(2025, 11, 3, 9)) == [] and ids() == []
    publish_arrivals(_events(spark, range(0, 10)), topic, datetime(2025, 11, 3, 10, 5))
    assert poll(datetime(2025, 11, 3, 10, 10)) == ["2025110310"]
    publish_arrivals(_events(spark, range(10, 20)), topic, datetime(2025, 11, 3, 10, 50))
    publish_arrivals(_events(spark, range(20, 30)), topic, datetime(2025, 11, 3, 13, 0))
    assert poll(datetime(2025, 11, 3, 13, 0)) == ["2025110310", "2025110313"]
    assert open_hours(spark, topic, ckpt) == ["2025110313"]  # 10 ended at 11, and an hour of grace at 12
    assert ids() == [i for i in range(30) if i % 5] and ids("rejects") == list(range(0, 30, 5))
    # a file that is late for its hour waits for a sweep; nothing is read twice
    publish_arrivals(_events(spark, range(30, 40)), topic, datetime(2025, 11, 3, 10, 59))
    assert poll(datetime(2025, 11, 3, 13, 10)) == ["2025110313"] and len(ids()) == 24
    assert poll(datetime(2025, 11, 3, 13, 20), sweep=True) == ["2025110310", "2025110313"]
    assert ids() == [i for i in range(40) if i % 5] and open_hours(spark, topic, ckpt) == ["2025110313"]


def test_a_poll_that_dies_leaves_its_hour_open(spark, tmp_dir, monkeypatch):
    from fraudlens.streaming import ingest as ingest_module

    topic, ckpt = f"{tmp_dir}/topic", f"{tmp_dir}/ckpt"
    publish_arrivals(_events(spark, range(10)), topic, datetime(2025, 11, 3, 1))

    def poll():
        return ingest_open(spark, topic, f"{tmp_dir}/orders", ckpt, datetime(2025, 11, 4), f"{tmp_dir}/rejects")

    with monkeypatch.context() as m:

        def dies(df):
            raise RuntimeError("lost")

        m.setattr(ingest_module, "order_rejects", dies)
        with pytest.raises(Exception, match="lost"):
            poll()
    assert read_arrivals(spark, ckpt).count() == 0
    assert poll() == ["2025110301"] and read_arrivals(spark, ckpt).count() == 8 and read_arrivals(spark, ckpt, "rejects").count() == 2
    assert poll() == []
