"""The batch plan from CSV files, and the same cleaning on a stream."""

import csv
import random
from datetime import datetime, timedelta

import pytest

from sensorloom.plans import pipeline
from sensorloom.sources import io
from sensorloom.streaming.clean import stream_clean

DAY = datetime(2022, 3, 1)


def write(folder, name, header, rows):
    with open(folder / f"{name}.csv", "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow(header)
        w.writerows(rows)


@pytest.fixture(scope="module")
def source(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    rng = random.Random(4)
    stamp = lambda t: t.strftime("%Y-%m-%d %H:%M:%S+00")
    readings = [(u, stamp(DAY + timedelta(minutes=5 * i)), 100 + 20 * (i % 12 == 3) + u) for u in (1, 2) for i in range(900)]
    readings += [(1, "garbage", 100), (1, stamp(DAY), 39), (2, stamp(DAY), 401), (2, "2019-05-05 10:00:00+00", 100)]
    write(folder, "glucose", ["id", "timestamp", "value_decimal"], readings)
    meals, lines = [], []
    for i in range(24):
        t = DAY + timedelta(minutes=200 * i + 61)
        meals.append((100 + i, 1 + i % 2, stamp(t), rng.choice(["main", "snack", ""])))
        if i != 5:
            for j in range(3):
                lines.append((len(lines), 100 + i, j, "Pan", 100, 200, 5, 3, 30 - (60 if i == 7 and j == 0 else 0)))
    write(folder, "meal", ["id", "user_id", "timestamp", "type"], meals)
    write(folder, "meal_item", ["id", "meal_id", "food_id", "food_name", "amount", "calories", "protein", "fat", "carbs"], lines)
    write(folder, "food_composition",
          ["food_id", "food_esp_name", "food_group_id", "fibre_gram_value", "atri_ultraprocessed", "atri_high_glycemic_index",
           "saturated_fatty_acid", "carbohydrate_gram_value", "fat_grams_value", "protein_gram_value", "portion"],
          [(0, " pan ", 1, 3, "Si", "No", 0.5, 50, 2, 8, "x"), (1, "Pollo", 2, 0, "No", "Si", 1, 0, 9, 30, 150)])
    write(folder, "sport", ["user_id", "timestamp", "type", "duration"],
          [(1, stamp(DAY + timedelta(hours=h)), "Correr", h % 3 * 20) for h in range(0, 70, 7)])
    write(folder, "questionnaire_morning",
          ["user_id", "timestamp", "sleep_time", "sleep_quality", "resting_hr", "hr_variability", "glucose_basal", "sickness"],
          [(1, stamp(DAY + timedelta(days=d, hours=7)), 420, 3, 60, 50, 95, d == 1) for d in range(3)])
    write(folder, "questionnaire_night", ["user_id", "timestamp", "trainning_effort", "anxiety_level", "out_of_routine"],
          [(1, stamp(DAY + timedelta(days=d, hours=21)), 5, 2, True) for d in range(3)])
    return str(folder)


def test_batch_from_csv(spark, source, tmp_path):
    out = pipeline.run_batch(spark, source, str(tmp_path))
    assert out["readings"].count() == 1800
    assert out["meals"].where("not has_items").count() == 1
    log = {(r.table, r.action): r.n_affected for r in out["cleaning_log"].collect()}
    assert log["glucose", "time not read: value becomes null"] == 1
    assert log["glucose", "reading < 40: row goes"] == log["glucose", "reading > 400: row goes"] == 1
    assert log["glucose", "time too early or missing: row goes"] == 2
    assert log["meal_item", "carbs < 0: value becomes null"] == 1
    quality = {r.user_id: r for r in out["user_quality"].collect()}
    assert quality[1].has_glucose and not quality[1].has_meals and quality[1].has_sport
    base = {r.meal_id: r for r in out["modeling_dataset"].collect()}
    assert 105 not in base and len(base) == 22  # one meal lacks items, one has too few readings after it
    first = base[100]
    assert first.peak_value == 121 and first.amplitude == 20
    assert first.time_to_peak_min == pytest.approx(14)
    assert (first.n_ultraprocessed, first.n_high_gi, first.n_items, first.total_fibre) == (1, 1, 3, 3)
    assert base[116].is_sick is False and base[114].sleep_time_prev == 420
    peak = out["modeling_dataset_peak"]
    assert peak.count() == 22 and peak.where("cgm_slope_60m is not null").count() >= 20
    wanted = pipeline.feature_columns(pipeline.with_codes(peak))
    assert "cgm_slope_best" in wanted and "meal_type_enc" in wanted and "cgm_slope_60m" not in wanted


def test_scan_is_pruned_and_filter_pushed(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id", "cast(id as double) v", "'x' s").write.parquet(path)
    from sensorloom.operators.clean import keep_range

    plan = keep_range(io.read_table(spark, path).select("id", "v"), "v", 40, 60)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(v,40.0)" in plan and "ReadSchema: struct<id:bigint,v:double>" in plan


def test_one_client_reads_one_folder(spark, tmp_path):
    path = str(tmp_path / "c")
    io.write_table(spark.range(30).selectExpr("id", "cast(id % 3 as int) partition_id"), path, partition_by=["partition_id"])
    shard = io.read_shard(spark, path, 1)
    assert shard.count() == 10
    assert "PartitionFilters: [isnotnull(partition_id" in shard._jdf.queryExecution().toString()


def test_stream_gives_what_the_batch_gives(spark, source, tmp_path):
    q = stream_clean(spark, source, "glucose", str(tmp_path / "out"), str(tmp_path / "log"))
    q.awaitTermination(120)
    got = io.read_table(spark, str(tmp_path / "out"))
    batch = io.load_clean(spark, source)["readings"]
    assert got.count() == 1800 and got.exceptAll(batch.select(got.columns)).count() == 0
