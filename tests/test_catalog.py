"""Catalog planning, versions, union by name, upserts and replacement."""

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.functions import text
from tidemark.sources import catalog


def test_plan_keeps_finished_units_and_names_tables(spark):
    keys = spark.createDataFrame([(k,) for k in ["pc1/1.9/s/data/d_snapshots.parquet", "pc1/1.10/s/data/d.parquet", "pc2/1.9/s/data/d.parquet", "pc1/1.9/s/run.json", "x"]], "key string")
    got = {(r["unit"], r["version"], r["table"]) for r in catalog.plan(keys, spark.createDataFrame([("pc1",)], "unit string")).collect()}
    assert got == {("pc1", "1.9", "snapshots"), ("pc1", "1.10", "dataset")}
    assert catalog.newest_version(catalog.plan(keys)).first()["version"] == "1.10"


def test_union_by_name_casts_to_the_contract(spark, tmp_path):
    spark.createDataFrame([(1, "5")], "a long, b string").write.parquet(str(tmp_path / "x"))
    spark.createDataFrame([("2",)], "a string").write.parquet(str(tmp_path / "y"))
    schema = StructType([StructField("a", LongType()), StructField("b", StringType())])
    got = catalog.read_by_name(spark, [str(tmp_path / "x"), str(tmp_path / "y")], schema)
    assert sorted((r["a"], r["b"]) for r in got.collect()) == [(1, "5"), (2, None)] and got.columns[-1] == "filename"
    assert catalog.read_by_name(spark, [], schema).count() == 0


def test_upsert_and_replace(spark, tmp_path):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    new = spark.createDataFrame([(2, "c", 9)], "k long, v string, w long")
    got = sorted((r["k"], r["v"], r["w"]) for r in catalog.upsert(old, new, ["k"]).collect())
    assert got == [(1, "a", None), (2, "c", 9)]
    root = str(tmp_path / "t")
    assert catalog.current_generation(spark, root) is None
    catalog.replace_tables({"a": old, "b": old}, root)
    first, reader = catalog.current_generation(spark, root), catalog.current_table(spark, root, "b")
    catalog.replace_tables({"a": new}, root)
    second = catalog.current_generation(spark, root)
    assert catalog.current_table(spark, root, "a").count() == 1 and second != first and reader.count() == 2  # within the lease
    # a torn commit and a folder without one count for nothing
    (tmp_path / "t" / "commits" / "7.json").write_text('{"generation": "gen')
    old.write.parquet(f"{root}/generation-crashed/a")
    assert catalog.current_generation(spark, root) == second
    third = catalog.replace_tables({"a": old}, root, lease=0)
    assert catalog.current_generation(spark, root) == third and (tmp_path / "t" / "commits" / "8.json").exists()
    assert sorted(p.name for p in (tmp_path / "t").iterdir() if not p.name.startswith(".")) == sorted(["commits", third])


def test_text_rules(spark):
    df = spark.createDataFrame([("src/tests/a_test.py", "password = hunter2 ok")], "path string, line string")
    row = df.select(text.path_flags(F.col("path"))["is_test"].alias("t"), text.redact(F.col("line")).alias("r"), text.log_level(F.lit("a Warning: x")).alias("l"), text.is_word_in(F.lit("hotfix1 fix!"), "fix").alias("w")).first()
    assert row["t"] and row["r"] == "password = [secret] ok" and row["l"] == "warn" and row["w"]
