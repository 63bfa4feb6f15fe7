"""Landing of files: malformed lines, drifting schemas, repeated and broken-off landings."""
from lotline.sources import landing
from lotline.sources.lakehouse import write_table
from pyspark.sql import functions as F

SCHEMA = "id long, amount decimal(10,2), at date, tags array<string>"


def land(spark, tmp_path):
    return landing.land_files(spark, f"{tmp_path}/in", f"{tmp_path}/lake", "t", SCHEMA, as_of="2024-01-01 00:00:00")


def test_landing(spark, tmp_path):
    (tmp_path / "in" / "x").mkdir(parents=True)
    (tmp_path / "in" / "a.json").write_text('{"id":1,"amount":2.5,"at":"2024-01-02","tags":["x","y"]}\n\n{"id":2\nno json\n[1]\n{"id":"seven"}\n')
    assert land(spark, tmp_path) == 1 and land(spark, tmp_path) == 0
    (tmp_path / "in" / "x" / "b.json").write_text('{"id":3,"colour":"red","n":{"k":1}}\n{}\n{"id":null,"at":"not a day"}\n{"id":1,"amount":2.5}\n')
    assert land(spark, tmp_path) == 1 and land(spark, tmp_path) == 0
    root = f"{tmp_path}/lake"
    got = landing.read_landed(spark, root, "t")
    assert sorted((r.id or 0, str(r.amount), str(r["at"]), r.tags, r.extra, r.source_file[-6:]) for r in got.collect()) == [
        (0, "None", "None", None, None, "b.json"), (1, "2.50", "2024-01-02", ["x", "y"], None, "a.json"), (1, "2.50", "None", None, None, "b.json"),
        (3, "None", "None", None, {"colour": "red", "n": '{"k":1}'}, "b.json")]
    bad = landing.read_landed(spark, root, "t", rejected=True)
    assert sorted((r.record, r.reason) for r in bad.collect()) == [
        ("[1]", "malformed"), ("no json", "malformed"), ('{"id":"seven"}', "type:id"), ('{"id":2', "malformed"), ('{"id":null,"at":"not a day"}', "type:at")]
    # a landing that broke off before its files were noted is not read, and lands whole the next time
    write_table(got.withColumn("batch", F.lit("broken off")), root, "bronze", "t", mode="append")
    assert landing.read_landed(spark, root, "t").count() == 4


def test_array_payload(spark):
    raw = spark.createDataFrame([(1, '{"a":1,"b":["x","y"]}'), (2, '{"a":2,"b":[]}'), (3, "{}"), (4, None)], "id int, payload string")
    got = landing.explode_payload(raw, "payload", "a int, b array<string>", array_col="b", keep=("id",))
    assert sorted((r.id, r.a, r.b) for r in got.collect() if r.b) == [(1, 1, "x"), (1, 1, "y")] and got.filter("b is null").count() == 3
