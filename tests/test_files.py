import hashlib

import pytest
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import ledgers as G
from millrace.sources import readers, sinks
from millrace.streaming.changes import event_counts, lexicon_stream


def test_csv_keeps_everything(spark, rows, tmp_path):
    df = spark.createDataFrame([("1", ' a,"b"\nc '), ("2", ""), ("3", "x")], "k string, v string")
    sinks.write_csv(df, str(tmp_path / "c"))
    assert rows(readers.read_csv_as_text(spark, str(tmp_path / "c"), ["k", "v"])) == rows(df)


def test_text_forms(spark, rows, tmp_path):
    pairs = spark.createDataFrame([(0, 1), (0, 1), (0, 2), (3, 4)], "u bigint, i bigint")
    sinks.write_adjacency(pairs, "u", "i", str(tmp_path / "a"))
    assert rows(readers.read_adjacency(spark, str(tmp_path / "a"))) == [(0, 1), (0, 2), (3, 4)]
    (tmp_path / "m").write_text("org_id remap_id\nitem:780 0\nregion:West Bengal 1\n")
    assert rows(readers.read_id_map(spark, str(tmp_path / "m"))) == [("item:780", 0), ("region:West Bengal", 1)]
    (tmp_path / "n").write_text("a 0\na 1\n")
    with pytest.raises(ValueError):
        readers.read_id_map(spark, str(tmp_path / "n"))
    (tmp_path / "t").write_text("1 2 3\n4 5\n")
    with pytest.raises(Exception, match="no triple"):
        readers.read_triples(spark, str(tmp_path / "t")).collect()


def test_pinned_and_stubs(spark, tmp_path):
    sinks.write_parquet(spark.range(10), str(tmp_path / "p"), keys=["id"])
    (tmp_path / "p" / "stub.parquet").write_text("version https://example")
    kinds = {r["is_parquet"] for r in readers.materialised(spark, str(tmp_path / "p")).where("path LIKE '%.parquet'").collect()}
    assert kinds == {True, False}
    f = tmp_path / "x.json"
    f.write_text('{"a": 1}\n')
    digest = hashlib.sha256(f.read_bytes()).hexdigest()
    assert readers.read_pinned(spark, str(f), digest, "json").first()["a"] == 1
    with pytest.raises(ValueError):
        readers.read_pinned(spark, str(f), "0" * 64, "json")


def test_guards_and_receipts(spark, tmp_path):
    with pytest.raises(ValueError):
        sinks.guard_output(str(tmp_path / "a" / "b"), [str(tmp_path / "a")])
    assert sinks.guard_output(str(tmp_path / "c"), [str(tmp_path / "a")])
    df = spark.range(5)
    assert sinks.receipt(df) == sinks.receipt(df.repartition(3))
    sinks.write_json({"b": 1}, str(tmp_path / "r.json"))
    assert readers.read_manifest(str(tmp_path / "r.json")) == {"b": 1}
    assert "| 0 |" in sinks.render_markdown(df, "t")


def test_streams_agree_with_batches(spark, rows, tmp_path):
    data = [(i, f"2024-01-01 0{i % 5}:10:00", ["salt", "milk tea", "coconut milk", None][i % 4]) for i in range(40)]
    df = spark.createDataFrame(data, "k int, at string, text string").withColumn("at", F.to_timestamp("at"))
    df.write.parquet(str(tmp_path / "s"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "s"))
    lexicon = {"milk": (r"\bmilk\b", "coconut milk")}
    for name, f in (("a", lambda d: lexicon_stream(d, "text", "at", lexicon)), ("b", lambda d: event_counts(d, "at", "text"))):
        q = f(stream).writeStream.outputMode("complete").format("memory").queryName(f"stream_{name}").start()
        q.processAllAvailable()
        q.stop()
        assert rows(spark.table(f"stream_{name}")) == rows(f(df)) != []


def test_json_and_html(spark):
    df = spark.createDataFrame([('{"a": 1, "b": {"c": 2, "d": 3}, "l": [{"c": 1, "x": 2}]}', "<p>a &amp; b<script>x<y</script></p>"), ("[1]", None)], "j string, h string")
    got = [r["v"] for r in df.select(T.kept_keys(F.col("j"), {"a": True, "b": {"c": True}, "l": {"c": True}}).alias("v")).collect()]
    assert got == ['{"a": 1, "b": {"c": 2}, "l": [{"c": 1}]}', None]
    assert [r["v"] for r in df.select(T.html_text(F.col("h")).alias("v")).collect()] == ["a & b", None]
    assert T.pattern_digest({"a": 1, "b": [2]}) == T.pattern_digest({"b": [2], "a": 1})


def test_ledgers(spark, rows):
    df = spark.createDataFrame([(1, "a:x;b:y", "b:z;c:w"), (2, "bad", "a:x")], "k int, p string, n string")
    assert rows(G.tier_changes(df, "k", "p", "n"))[0] == (1, ["a"], ["c"], ["b"])
    ok = spark.createDataFrame([(0.5, 0.5), (None, 0.2), (0.3, None), (None, None)], "o double, n double")
    assert sorted(r[0] for r in G.one_name(ok, "o", "n", 0, 1).where("n IS NOT NULL").collect()) == [0.2, 0.3, 0.5]
    for bad in ((0.5, 0.6), (None, 1.5)):
        with pytest.raises(Exception, match="disagree|bounds"):
            G.one_name(spark.createDataFrame([bad], "o double, n double"), "o", "n", 0, 1).collect()
