import pytest
from pyspark.sql import types as T

from salesloom.streaming import compaction as C

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.LongType()), T.StructField("v", T.StringType())])


def arrive(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def drain(spark, folder, path, mark):
    arriving = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    C.merge_stream(arriving, path, "k", ["n"], mark).awaitTermination()


def have(spark, path):
    return sorted(map(tuple, C.read_compacted(spark, path, SCHEMA).collect()), key=str)


def rows_of(first, count=6):
    return [(f"k{(first * 4 + i) % 20:02}", first * 100 + i, f"v{first}") for i in range(count)] + [(None, first * 100 + 50, "null")]


def wanted(rounds):
    """The first row of each key; null keys stay."""
    found, nulls = {}, []
    for r in rounds:
        for row in rows_of(r):
            if row[0] is None:
                nulls.append(row)
            else:
                found.setdefault(row[0], row)
    return sorted([*found.values(), *nulls], key=str)


def test_stream_compacted_between(spark, tmp_path):
    folder, path, mark = (str(tmp_path / n) for n in ("in", "target", "mark"))
    assert have(spark, path) == []
    for r in range(3):
        arrive(spark, folder, rows_of(r))
        drain(spark, folder, path, mark)
    assert C.compact(spark, path, SCHEMA, "k", upto=1, files=2) == {"number": 1, "base": "base=1", "covers": 1}
    assert have(spark, path) == wanted(range(3))
    for r in range(3, 6):
        arrive(spark, folder, rows_of(r))
        drain(spark, folder, path, mark)
    assert C.compact(spark, path, SCHEMA, "k", upto=4, files=2)["covers"] == 4
    assert have(spark, path) == wanted(range(6))
    assert C.expire(spark, path) == ["batch=0", "batch=1"]
    assert have(spark, path) == wanted(range(6))
    # Nothing is due, so nothing is written.
    assert C.compact(spark, path, SCHEMA, "k", upto=4, files=2)["number"] == 2


@pytest.mark.parametrize("step", ["before", "switch"])
def test_compaction_that_dies(spark, tmp_path, monkeypatch, step):
    folder, path, mark = (str(tmp_path / n) for n in ("in", "target", "mark"))
    for r in range(3):
        arrive(spark, folder, rows_of(r))
        drain(spark, folder, path, mark)

    def dies(*args):
        if step == "switch":
            switch(*args)
        raise RuntimeError("lost")

    switch = C._switch
    monkeypatch.setattr(C, "_switch", dies)
    with pytest.raises(RuntimeError, match="lost"):
        C.compact(spark, path, SCHEMA, "k", upto=2, files=2)
    monkeypatch.setattr(C, "_switch", switch)
    assert have(spark, path) == wanted(range(3))
    assert C.compact(spark, path, SCHEMA, "k", upto=2, files=2)["number"] == 1
    assert have(spark, path) == wanted(range(3))


def test_replayed_batches(spark, tmp_path):
    path = str(tmp_path / "target")
    batches = [spark.createDataFrame(rows_of(r), SCHEMA) for r in range(3)]
    for number, batch in enumerate(batches):
        C.merge_batch(batch, number, path, "k", ["n"])
    C.merge_batch(batches[2], 2, path, "k", ["n"])
    assert have(spark, path) == wanted(range(3))
    C.compact(spark, path, SCHEMA, "k", upto=2, files=1)
    C.merge_batch(batches[2], 2, path, "k", ["n"])
    assert have(spark, path) == wanted(range(3))


def test_second_compaction_is_refused(spark, tmp_path):
    path = str(tmp_path / "target")
    C.merge_batch(spark.createDataFrame(rows_of(0), SCHEMA), 0, path, "k", ["n"])
    made = C.compact(spark, path, SCHEMA, "k", upto=0, files=1)
    with pytest.raises(RuntimeError, match="Another compaction"):
        C._switch(spark, path, made)


def test_files_are_sorted_and_apart(spark, tmp_path):
    path = str(tmp_path / "target")
    for r in range(4):
        C.merge_batch(spark.createDataFrame([(f"k{i:03}", i, "v") for i in range(r * 50, r * 50 + 50)], SCHEMA), r, path, "k", ["n"])
    C.compact(spark, path, SCHEMA, "k", upto=3, files=4)
    spans = []
    for file in (tmp_path / "target" / "base=1").glob("*.parquet"):
        keys = [r.k for r in spark.read.schema(SCHEMA).parquet(str(file)).collect()]
        assert keys == sorted(keys)
        if keys:
            spans.append((keys[0], keys[-1]))
    spans.sort()
    assert len(spans) > 1 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
