import json

from cairnfield.operators import dml
from cairnfield.sources import files
from cairnfield.sources.tables import Catalog, read
from cairnfield.streaming import incremental


def test_names_of_a_run():
    c = Catalog("_7_prod", ("TEMP",))
    assert c.name("MASTER", "LOCATION") == "MASTER_7_prod.LOCATION" and c.name("TEMP", "CACHE") == "TEMP.CACHE"


def test_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\n1,x\n2,y\n")
    (tmp_path / "b.csv").write_text("k,v\n3,z\n")
    rows = files.read_csv(spark, str(tmp_path / "a.csv"), "k int, v string")
    assert [tuple(r) for r in rows.orderBy("k").collect()] == [(1, "x"), (2, "y")]
    assert files.read_training(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], "k int, v string", 2).count() == 2
    files.write_distinct(rows.unionAll(rows), str(tmp_path / "out"))
    assert files.read_csv(spark, str(tmp_path / "out"), "k int, v string").count() == 2
    scopes = files.number_workers(spark.range(7).withColumnRenamed("id", "k"), ["k"], 3, 2).selectExpr("k", "'sales' identifier", "'small' `group`", "bucket", "chunk")
    assert [r.chunk for r in scopes.orderBy("k").collect()] == [0, 0, 1, 0, 0, 0, 0]
    files.write_scopes(scopes, str(tmp_path / "scopes"))
    assert {r.k for r in files.read_scopes(spark, str(tmp_path / "scopes"), "sales", "small", 0).collect()} == {0, 1, 2}
    files.write_run(str(tmp_path / "run.json"), {"run": "7"})
    assert json.loads((tmp_path / "run.json").read_text()) == {"run": "7"}
    text = files.describe_columns(rows, {"k": 'a "key"', "v": "two\nlines"}, "t")
    assert '        description: "a \\"key\\""' in text and "          lines" in text


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "a int")
    spark.sql("drop table if exists sink_test")
    dml.append(df, "sink_test")
    dml.write(df, "sink_test")
    assert spark.table("sink_test").count() == 2
    dml.write(df, "sink_test", True)
    assert spark.table("sink_test").count() == 1
    spark.sql("drop table sink_test")


def test_incremental_stream(spark, tmp_path):
    folder, out, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    write = lambda rows: spark.createDataFrame(rows, "ID int, v string").write.mode("append").parquet(f"{folder}/t.parquet")
    write([(1, "a"), (1, "a"), (2, None)])
    for rows in ([(2, None), (3, "c")], []):
        incremental.append_new(incremental.read_stream(spark, folder, "t"), out, ["ID", "v"], mark).awaitTermination()
        if rows:
            write(rows)
    assert sorted((r.ID, r.v or "") for r in spark.read.parquet(out).collect()) == [(1, "a"), (2, ""), (3, "c")]
    incremental.each_batch(incremental.read_stream(spark, folder, "t"), lambda b: b.groupBy().count(), str(tmp_path / "sums"), str(tmp_path / "mark2")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "sums")).selectExpr("sum(count)").first()[0] == 5
    assert incremental.open_rows(read(spark, folder, "t"), "v").count() == 2
