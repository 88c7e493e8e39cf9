import datetime as dt
import os
import uuid
from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F

from evenkeel import (
    Labels,
    Options,
    ReconcileSpec,
    SideSpec,
    compare,
    read_differences,
    run,
    run_many,
    save_differences,
    summarize,
)
from evenkeel.plans.run import Outcome, outcome_rows
from evenkeel.sinks.differences import save_set
from evenkeel.sinks.reports import read_report, summary_rows, write_report
from evenkeel.workspace import shared_folder

SOURCE = [(1, "oak", 31), (2, "elm", 17), (3, "ash", 8)]
TARGET = [(1, "oak", 31), (2, "elm", 19), (4, "fir", 52)]
SCHEMA = "id int, name string, value int"


def frames(spark):
    return spark.createDataFrame(SOURCE, SCHEMA), spark.createDataFrame(TARGET, SCHEMA)


def folders(path):
    return sorted(
        os.path.relpath(os.path.join(base, name), path)
        for base, names, _ in os.walk(path)
        for name in names
        if name.startswith("dt=")
    )


def test_difference_sets(spark, tmp_path):
    out = str(tmp_path)
    paths = save_differences(compare(*frames(spark), "id"), out, "t", "2024-01-15")
    assert folders(out) == [
        "t/column_differences/dt=2024-01-15", "t/source_only/dt=2024-01-15", "t/target_only/dt=2024-01-15",
    ]
    assert set(paths) == {"source_only", "target_only", "column_differences"}
    missing = read_differences(spark, out, "t", "source_only", "2024-01-15")
    assert {"_composite_key", "_row_hash", "dt"} < set(missing.columns)
    assert [(r.id, r.dt) for r in missing.collect()] == [(3, dt.date(2024, 1, 15))]
    changed = read_differences(spark, out, "t", "column_differences")
    row = changed.select("source.id", F.col("source.value").alias("s"), F.col("target.value").alias("t")).first()
    assert tuple(row) == (2, 17, 19)


def test_days_of_different_columns(spark, tmp_path):
    out = str(tmp_path)
    for day, values in (("2024-01-01", "1 as id, 'a' as v"), ("2024-01-02", "2 as id, 'b' as v, 7 as w")):
        source = spark.sql(f"select {values}")
        save_differences(compare(source, source.withColumn("v", F.lit("z")), "id"), out, "t", day)
        save_differences(compare(source, source.limit(0), "id"), out, "one", day)
    rows = read_differences(spark, out, "one", "source_only")
    assert sorted((r.id, r.v, r.w, str(r.dt)) for r in rows.collect()) == [(1, "a", None, "2024-01-01"), (2, "b", 7, "2024-01-02")]
    assert "w" not in read_differences(spark, out, "one", "source_only", "2024-01-01").columns
    assert [r.w for r in read_differences(spark, out, "one", "source_only", "2024-01-02").collect()] == [7]
    assert read_differences(spark, out, "one", "source_only", "2024-01-03").collect() == []
    pairs = read_differences(spark, out, "t", "column_differences")
    assert sorted((r.source.id, r.source.w) for r in pairs.collect()) == [(1, None), (2, 7)]
    source = spark.sql("select 3 as id, array(1) as v")
    save_differences(compare(source, source.limit(0), "id"), out, "one", "2024-01-03")
    with pytest.raises(ValueError, match="don't go together"):
        read_differences(spark, out, "one", "source_only")
    assert read_differences(spark, out, "one", "source_only", "2024-01-03").count() == 1


def test_failed_rerun_keeps_the_stored_day(spark, tmp_path):
    folder = str(tmp_path / "t" / "source_only")
    save_set(spark.range(5), 5, folder, "2024-01-15")
    save_set(spark.range(3), 3, folder, "2024-01-14")
    failing = spark.range(9).withColumn("id", F.when(F.col("id") > 7, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        save_set(failing, 9, folder, "2024-01-15")
    counts = {str(r.dt): r["count"] for r in spark.read.parquet(folder).groupBy("dt").count().collect()}
    assert counts == {"2024-01-14": 3, "2024-01-15": 5}
    save_set(spark.range(4).withColumn("DT", F.lit("x")), 4, folder, "2024-01-15")
    assert read_differences(spark, str(tmp_path), "t", "source_only", "2024-01-15").count() == 4


def test_rerun_without_differences_leaves_nothing_stale(spark, tmp_path):
    source, target = frames(spark)
    out = str(tmp_path)
    save_differences(compare(source, target, "id"), out, "t", "2024-01-15")
    save_differences(compare(source, target, "id"), out, "t", "2024-01-14")
    assert save_differences(compare(source, source, "id"), out, "t", "2024-01-15") == {}
    for kind in ("source_only", "target_only", "column_differences"):
        assert read_differences(spark, out, "t", kind, "2024-01-15").count() == 0
        assert read_differences(spark, out, "t", kind, "2024-01-14").count() == 1
    save_differences(compare(source, source, "id"), out, "fresh", "2024-01-15")
    assert not os.path.exists(f"{out}/fresh")


def test_labels(spark, tmp_path):
    out = str(tmp_path)
    comparison = compare(*frames(spark), "id")
    save_differences(comparison, out, "t", "2024-01-15", Labels("left", "right"))
    assert read_differences(spark, out, "t", "right_only").count() == 1
    assert read_differences(spark, out, "t", "column_differences").select("left.value", "right.name").count() == 1
    assert comparison.differing == {"value": 1}


def test_stored_pairs_serve_the_column_counts(spark, tmp_path):
    source = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (2, "d"), (3, "e")], "id int, v string")
    target = spark.createDataFrame([(1, "a"), (1, "x"), (2, "c"), (2, "d"), (3, "f")], "id int, v string")
    for number, options in enumerate((Options(), Options(pair_rows=1), Options(pair_rows=1, hot_rows=1, broadcast_bytes=0))):
        for layout in ("pairs", "rows"):
            comparison = compare(source, target, "id", options)
            before = comparison.column_differences().collect()
            out = str(tmp_path / str(number) / layout)
            save_differences(comparison, out, "t", "2024-01-15", layout=layout)
            assert comparison.column_differences().collect() == before
            assert comparison.differing == {"v": 6}
            assert read_differences(spark, out, "t", "column_differences").count() == (6 if layout == "pairs" else 10)


def test_a_table_that_changes_between_the_steps(spark, tmp_path):
    path = str(tmp_path / "t")
    source, target = frames(spark)
    source.write.parquet(path)
    comparison = compare(spark.read.parquet(path), target, "id", Options(broadcast_bytes=0))
    assert comparison.totals.source_only == 1
    spark.createDataFrame([(9, "yew", 1), (3, "ash", 8)], SCHEMA).write.mode("overwrite").parquet(path)
    spark.catalog.refreshByPath(path)
    comparison.source = compare(spark.read.parquet(path), target, "id").source.where("id <> 3")
    with pytest.raises(RuntimeError, match="changed meanwhile"):
        save_differences(comparison, str(tmp_path / "out"), "t", "2024-01-15")


def test_a_set_that_never_held_rows(spark, tmp_path):
    source, _ = frames(spark)
    save_differences(compare(source, source, "id"), str(tmp_path), "t", "2024-01-15")
    with pytest.raises(FileNotFoundError, match="source_only"):
        read_differences(spark, str(tmp_path), "t", "source_only")
    assert read_differences(spark, str(tmp_path), "t", "source_only", schema="id int").collect() == []


def daily_spec(spark, tmp_path, **changes):
    rows = [(i, f"2024-01-{d:02d}", i * d) for i in range(5) for d in (14, 15)]
    spark.createDataFrame(rows, "id int, day string, value int").createOrReplaceTempView("daily_source")
    spark.createDataFrame(
        [(i, day.replace("-", ""), v + (i == 2 and day.endswith("15"))) for i, day, v in rows if i != 4],
        "ID int, DAY string, VALUE int",
    ).createOrReplaceTempView("daily_target")
    given = {
        "source": SideSpec(table="daily_source", date_column="day", exclude="day"),
        "target": SideSpec(table="daily_target", date_column="day", date_format="yyyymmdd", exclude="day"),
        "output_path": str(tmp_path / "out"),
        "report_path": str(tmp_path / "reports"),
        **changes,
    }
    return ReconcileSpec("daily", keys="id", **given)


def test_run_for_a_day(spark, tmp_path):
    outcome = run(spark, daily_spec(spark, tmp_path), as_of="2024-01-17")
    assert outcome.day == "2024-01-15" and outcome.is_match is False
    assert outcome.counts == {
        "source_rows": 5, "target_rows": 4, "source_only": 1, "target_only": 0, "matched": 4, "changed": 1,
    }
    assert outcome.differing == {"value": 1} and set(outcome.paths) == {"source_only", "column_differences"}
    lines = read_report(spark, f"{tmp_path}/reports/validation_report_daily_2024-01-15").collect()
    report = {(r.section, r.metric): r.value for r in lines}
    assert report["verdict", "status"] == "different"
    assert report["column_differences", "value"] == "1"
    assert report["statistics", "source_rows"] == "5"
    assert report["tables", "source"] == "daily_source" and report["tables", "day"] == "2024-01-15"
    assert report["details", "source_only"].endswith("daily/source_only/dt=2024-01-15")
    assert ("details", "target_only") not in report


def test_run_without_outputs(spark, tmp_path):
    spec = daily_spec(spark, tmp_path, output_path=None, report_path=None)
    outcome = run(spark, spec, day="2024-01-14")
    assert outcome.is_match is False and outcome.paths == {} and not os.listdir(tmp_path)
    same = ReconcileSpec("same", spec.source, spec.source, "id")
    assert run(spark, same, day="2024-01-14").is_match is True


def test_run_removes_its_tables(spark, tmp_path):
    root = spark.conf.get("spark.checkpoint.dir", None)
    before = set(os.listdir(root)) if root and os.path.isdir(root) else set()
    run(spark, daily_spec(spark, tmp_path), day="2024-01-15")
    after = set(os.listdir(root)) if root and os.path.isdir(root) else set()
    assert {name for name in after - before if name.startswith("evenkeel-")} == set()


@pytest.mark.parametrize("workers", [1, 3])
def test_many_pairs(spark, tmp_path, workers):
    source, target = frames(spark)
    specs = [
        ReconcileSpec("good", SideSpec(frame=source), SideSpec(frame=source), "id"),
        ReconcileSpec("broken", SideSpec(path=str(tmp_path / "nowhere")), SideSpec(frame=source), "id"),
        ReconcileSpec("bad", SideSpec(frame=source), SideSpec(frame=target), "id"),
    ]
    rows = run_many(spark, specs, max_workers=workers)
    got = {r.name: r for r in rows.collect()}
    assert [r.name for r in rows.collect()] == ["good", "broken", "bad"]
    assert got["good"].is_match is True and got["good"].error is None
    assert got["broken"].is_match is None and "PATH_NOT_FOUND" in got["broken"].error
    assert got["bad"].is_match is False and got["bad"].differing_columns == 1 and got["bad"].matched == 2
    summary = summarize(rows).first()
    assert (summary.total_tables, summary.success_count, summary.failure_count) == (3, 1, 2)
    assert (summary.success_percent, summary.failure_percent) == (33.3, 66.7)
    assert summary.success_tables == ["good"] and summary.failed_tables == ["bad", "broken"]
    path = write_report(summary_rows(summarize(rows)), str(tmp_path), "summary")
    assert {r.metric: r.value for r in read_report(spark, path).collect()}["failed_tables"] == "bad,broken"


def test_pairs_need_names_of_their_own(spark):
    specs = [ReconcileSpec.for_tables("t", "id", source_namespace=name) for name in ("a", "b", "a")]
    assert [spec.name for spec in specs] == ["a.t", "b.t", "a.t"]
    with pytest.raises(ValueError, match="same name"):
        run_many(spark, specs)


def test_a_failure_keeps_its_day(spark, tmp_path):
    spec = ReconcileSpec("lost", SideSpec(path=str(tmp_path / "x"), date_column="d"), SideSpec(path=str(tmp_path / "y")), "id")
    row = run_many(spark, [spec], as_of="2024-01-17").first()
    assert row.day == "2024-01-15" and row.is_match is None and row.error


def test_a_failed_second_read_leaves_no_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("evenkeel.plans.compare.shared_folder", lambda _: f"{tmp_path}/{uuid.uuid4().hex}")
    good = frames(spark)[0]
    broken = good.withColumn("value", F.raise_error(F.lit("lost connection")).cast("int"))
    given = iter([good, broken])
    monkeypatch.setattr("evenkeel.plans.run.scan", lambda *_: next(given))
    side = SideSpec(table="t", jdbc={"url": "jdbc:x"})
    with pytest.raises(Exception, match="lost connection"):
        run(spark, ReconcileSpec("t", side, side, "id"))
    assert not list(tmp_path.iterdir())


def test_summary_of_nothing(spark):
    summary = summarize(outcome_rows(spark, [])).first()
    assert summary.total_tables == 0 and summary.success_percent is None


def test_outcome_of_a_failure(spark):
    row = outcome_rows(spark, [Outcome("t", None, None, "boom")]).first()
    assert row.is_match is None and row.error == "boom" and row.differing_columns is None


def test_spec_for_tables(spark):
    spec = ReconcileSpec.for_tables("t", "id, code", source_namespace="app", jdbc={"url": "jdbc:x"}, date_column="d",
                                    exclude="a,b", target_where="x > 1", offset_days=3)
    assert (spec.name, spec.source.qualified_table, spec.target.qualified_table) == ("app.t", "app.t", "default.t")
    assert spec.source.jdbc and spec.target.jdbc is None and spec.is_daily and spec.offset_days == 3
    assert (spec.source.where, spec.target.where) == (None, "x > 1")
    frames(spark)[0].createOrReplaceTempView("plain_source")
    frames(spark)[1].createOrReplaceTempView("plain_target")
    plain = ReconcileSpec.for_tables("plain_source", "id", "plain_target", target_namespace=None, columns="ID,name")
    outcome = run(spark, plain)
    assert outcome.counts["changed"] == 0 and outcome.counts["source_only"] == 1 and outcome.day is None


def test_spec_needs_keys():
    with pytest.raises(ValueError, match="key column"):
        ReconcileSpec("t", SideSpec(table="a"), SideSpec(table="b"), [])


@pytest.mark.parametrize("master", ["yarn", "local[4]"])
def test_shared_folder_must_be_named(master):
    session = MagicMock()
    session.conf.get.side_effect = lambda name, default=None: {"spark.master": master}.get(name, default)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session)


def test_shared_folder_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark).startswith(named) and shared_folder(spark) != shared_folder(spark)
