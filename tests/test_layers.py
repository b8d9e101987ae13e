import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexer
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from playtide.sources import keyindex, layers


@pytest.fixture
def layer(spark, tmp_path):
    path = str(tmp_path / "layer")
    rows = [(i, ["NextSong", "Thumbs Up", None, ""][i % 4]) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, page string")
    for part in range(3):
        layers.append_layer(df.filter(F.col("id") % 3 == part).repartition(4), path)
    return path


def files(path):
    return [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]


def test_missing_and_empty_paths_are_not_there_yet(spark, tmp_path):
    assert layers.read_layer(spark, str(tmp_path / "none")) is None
    assert layers.read_layer(spark, str(tmp_path)) is None
    (tmp_path / "bad.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        layers.read_layer(spark, str(tmp_path)).count()


def test_pages_become_folders_and_blank_ones_read_as_null(spark, layer):
    df = layers.read_layer(spark, layer)
    assert df.count() == 40 and df.filter("page is null").count() == 20
    assert df.filter("page = 'Thumbs Up'").count() == 10
    assert "page" not in layers.read_layer(spark, layer, recursive=True).columns


def test_one_page_reads_one_folder(spark, layer):
    plan = layers.read_layer(spark, layer).filter("page = 'NextSong'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(page" in plan


def test_compaction_keeps_rows_and_drops_files(spark, layer, tmp_path):
    target = str(tmp_path / "compact")
    layers.compact_layer(spark, layer, target)
    assert len(files(target)) < len(files(layer))
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == list(range(40))


def test_corrupt_files_are_skipped_on_request(spark, tmp_path):
    path = str(tmp_path / "mixed")
    layers.replace_layer(spark.range(10), path)
    with open(f"{path}/broken.parquet", "w") as f:
        f.write("no parquet")
    assert layers.read_layer(spark, path, skip_corrupt=True).count() == 10


def test_stats_status_and_lag(spark, layer, tmp_path):
    stats = layers.layer_stats(spark, {"bronze": layer, "silver": str(tmp_path / "none")})
    rows = {r.layer: r for r in stats.collect()}
    assert rows["bronze"].files == len(files(layer)) and rows["bronze"].status == "READY"
    assert rows["bronze"].events_per_min == rows["bronze"].files * 2000
    assert rows["silver"].files == 0 and rows["silver"].status == "EMPTY"
    assert layers.layer_lag(stats).first().lag_min is None
    both = layers.layer_stats(spark, {"bronze": layer, "silver": layer})
    assert layers.layer_lag(both).first().lag_min == 0.0
    status = {r.name: r.status for r in layers.output_status(spark, {"a": layer, "b": "/nowhere"}).collect()}
    assert status == {"a": "READY", "b": "PENDING"}


def test_baseline_is_kept(spark, tmp_path):
    path = str(tmp_path / "baseline")
    assert layers.load_or_create_baseline(spark, path, spark.range(3)).count() == 3
    assert layers.load_or_create_baseline(spark, path, spark.range(9)).count() == 3


def test_models_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a",), ("b",)], "g string")
    model = Pipeline(stages=[StringIndexer(inputCol="g", outputCol="i")]).fit(df)
    layers.save_model(model, str(tmp_path / "m"))
    assert layers.load_model(PipelineModel, str(tmp_path / "m")).transform(df).count() == 2


def test_json_overwrites_one_day_only(spark, tmp_path):
    path = str(tmp_path / "json")
    layers.write_json(spark.createDataFrame([("d1", 1), ("d2", 2)], "day string, v int"), path, by="day")
    layers.write_json(spark.createDataFrame([("d2", 5)], "day string, v int"), path, by="day")
    assert {(r.day, r.v) for r in spark.read.json(path).collect()} == {("d1", 1), ("d2", 5)}


def test_other_errors_are_raised(spark, tmp_path):
    with pytest.raises(AnalysisException):
        spark.read.parquet(str(tmp_path / "none"))


def test_key_index_reads_the_days_of_the_increment(spark, tmp_path):
    path, day = str(tmp_path / "index"), keyindex.DAY_MS
    schema = "userId string, ts long, sessionId long, page string"
    stored = [(f"u{i % 5}", i * day // 4, i % 3, "p") for i in range(40)] + [(None, 3 * day, None, "p"), ("u", None, 1, "p")]
    keyindex.add_keys(spark.createDataFrame(stored[:20], schema), path)
    keyindex.add_keys(spark.createDataFrame(stored[20:], schema), path)
    assert keyindex.high_water(spark, path) == 39 * day // 4
    late = [("late", 2 * day + 5, 1, "p"), ("tied", 39 * day // 4, 1, "p"), ("newer", 50 * day, 1, "p"), (None, None, 1, "p"), ("u", None, 2, "p")]
    found = keyindex.unseen_rows(spark.createDataFrame(stored[5:] + late + late[:1], schema), path)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(late + late[:1], key=str)
    plan = keyindex.unseen_rows(spark.createDataFrame(late[:1], schema), path)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "IN" in plan.upper().split("PARTITIONFILTERS")[1][:120] or "= 2" in plan
    assert keyindex.unseen_rows(spark.createDataFrame(late, schema), str(tmp_path / "none")).count() == 5


def test_unreadable_files_are_listed(spark, tmp_path):
    path = tmp_path / "layer"
    assert layers.unreadable_files(spark, str(tmp_path / "none")).count() == 0
    layers.append_layer(spark.createDataFrame([(i, f"p {i % 2}") for i in range(10)], "id int, page string"), str(path))
    spark.createDataFrame([], "id int").write.mode("append").parquet(f"{path}/page=empty")  # whole, without rows
    assert layers.unreadable_files(spark, str(path)).count() == 0
    (path / "page=p 1" / "broken.parquet").write_text("no parquet")
    (path / "page=empty" / "cut.parquet").write_bytes(next((path / "page=p 1").glob("part*")).read_bytes()[:-9])
    found = {r.path.rsplit("/", 1)[1]: r.length for r in layers.unreadable_files(spark, str(path)).collect()}
    assert set(found) == {"broken.parquet", "cut.parquet"} and found["broken.parquet"] == 10


def test_a_published_table_is_seen_whole_or_not_at_all(spark, tmp_path):
    path = str(tmp_path / "gold")
    assert layers.read_published(spark, path) is None
    assert layers.publish_layer(spark.range(10), path) == 1
    reader = layers.read_published(spark, path)

    def dies(rows):
        raise ValueError("a task dies")

    with pytest.raises(Exception, match="a task dies"):
        layers.publish_layer(spark.range(20).mapInArrow(dies, "id long"), path)
    assert layers.read_published(spark, path).count() == 10
    assert layers.publish_layer(spark.range(30), path) == 2
    assert reader.count() == 10 and layers.read_published(spark, path).count() == 30
    assert layers.read_published(spark, path, 1).count() == 10 and layers.read_published(spark, path, 7) is None
