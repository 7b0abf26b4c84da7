"""Publishes that break off, loads run again, what is left behind, and the command line's switches."""

from __future__ import annotations

import json
import os
from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.plans import formatted
from tests.test_durable import Session
from tests.test_lake import FIRST, SECOND, business, land, review
from tidemark import files, versions
from tidemark.durable import CHECKPOINT_DIR, materialise, scratch, shared_folder
from tidemark.entities import DIM_BUSINESSES, FILE_PREFIX, raw_schema
from tidemark.jobs import arguments, main
from tidemark.load import LoadContext
from tidemark.operators.scd2 import changed_rows, scd2_delta
from tidemark.plans.lake import (
    Lake,
    build_dimension,
    build_facts,
    build_mart,
    ingest_load,
    newest_fact,
    read_dimension,
    read_fact,
    read_quality,
    run_jobs,
    standing,
)
from tidemark.sinks.writers import DIMENSION, overwrite_table, publish_dimension, replace_partitions
from tidemark.sources.readers import read_table
from tidemark.specs import CORRUPT_RECORD, DIGEST, EXTRA_FIELDS, DimSpec, Field

SPEC = DIM_BUSINESSES


def landed(root, n):
    folder = root / f"landing{n}"
    land(folder, "business", [business("a", 4.0), business("b", 3.0 + n), business(f"new{n}", 1.0)])
    land(folder, "user", [{"user_id": "u", "name": "U", "fans": n}])
    land(folder, "review", [review("a", "u", "2019-12-02", 4.0), review("b", "u", "2019-12-03", 2.0 + n)])
    land(folder, "tip", [{"business_id": "a", "user_id": "u", "date": "2019-12-10", "compliment_count": n}])
    land(folder, "checkin", [{"business_id": "b", "date": "2019-12-03 01:00:00, n/a" + ", 2019-12-04" * n}])
    return str(folder)


@pytest.fixture
def lake(spark, tmp_path):
    """Load 1 is through; load 2 is in bronze."""
    lake = Lake(str(tmp_path / "lake"))
    for n, load in [(1, FIRST), (2, SECOND)]:
        ingest_load(spark, lake, load, landed(tmp_path, n), workers=4)
    build_dimension(spark, lake, SPEC, FIRST)
    return lake


def versions_of(spark, lake):
    dim = read_dimension(spark, lake, SPEC)
    return sorted((r.business_id, r.business_nk, r.business_stars, r.effective_to, r.is_current) for r in dim.collect())


WHOLE = [
    (1, "a", 4.0, date(9999, 12, 31), True),
    (2, "b", 4.0, date(2020, 1, 31), False),
    (3, "new1", 1.0, date(9999, 12, 31), True),
    (4, "b", 5.0, date(9999, 12, 31), True),
    (5, "new2", 1.0, date(9999, 12, 31), True),
]


def second_delta(spark, lake):
    """What load 2 brings, and the version it starts from."""
    raw = read_table(spark, lake.bronze("business"), "orc", raw_schema("business").add("ctl_loading", T.IntegerType()))
    base = versions.live(spark, lake.silver(SPEC.table))
    current, marks = standing(spark, lake.silver(SPEC.table), base, SPEC)
    raw = SPEC.conform(raw.filter("ctl_loading = 2"))
    return scd2_delta(current, raw, SPEC, SECOND, marks=marks), base, marks


def folders(path):
    return sorted(name for name in os.listdir(path) if name.startswith("_run="))


def test_a_publish_that_broke_off_shows_nothing_and_is_run_again(spark, lake):
    """Killed when its rows are written and its pointer is not: nobody can clean up after it."""
    path, before = lake.silver(SPEC.table), versions_of(spark, lake)
    delta, _, _ = second_delta(spark, lake)
    delta.write.partitionBy(*DIMENSION).parquet(f"{path}/_run=killed")
    files.write_text(spark, f"{path}/_pointers/.draft", "half a poin")
    assert versions_of(spark, lake) == before != WHOLE
    build_dimension(spark, lake, SPEC, SECOND)
    assert versions_of(spark, lake) == WHOLE
    assert versions.sweep(spark, path, older_than_hours=1) == []
    assert versions.sweep(spark, path, older_than_hours=0) == ["_run=killed"] and versions_of(spark, lake) == WHOLE


def test_a_failing_write_leaves_the_table_and_no_folder(spark, lake):
    path, before = lake.silver(SPEC.table), versions_of(spark, lake)
    delta, base, marks = second_delta(spark, lake)
    fails = F.when(F.col("business_nk") == "new2", F.raise_error(F.lit("no")).cast("string")).otherwise(F.col("business_name"))
    runs = folders(path)
    with pytest.raises(Exception, match="no"):
        publish_dimension(delta.withColumn("business_name", fails), path, base=base, highest=marks)
    assert versions_of(spark, lake) == before and folders(path) == runs


def test_of_two_interleaved_runs_the_second_is_refused(spark, lake):
    """Both start from one version, and both write before either points."""
    path = lake.silver(SPEC.table)
    mine, base, marks = second_delta(spark, lake)
    theirs, _, _ = second_delta(spark, lake)
    publish_dimension(mine, path, base=base, highest=marks)
    runs = folders(path)
    with pytest.raises(versions.Conflict, match="version 2"):
        publish_dimension(theirs, path, base=base, highest=marks)
    assert versions_of(spark, lake) == WHOLE and folders(path) == runs
    build_dimension(spark, lake, SPEC, SECOND)
    assert versions_of(spark, lake) == WHOLE


def test_readers_see_a_publish_whole_or_not_at_all(spark, lake):
    """A reader that opened the table before, one while the rows are written, one after."""
    path = lake.silver(SPEC.table)
    opened, before = read_dimension(spark, lake, SPEC), versions_of(spark, lake)
    delta, base, marks = second_delta(spark, lake)
    seen = []

    def notes():  # asked between the rows and the pointer
        seen.append(versions_of(spark, lake))
        return {}

    versions.publish(delta, path, DIMENSION, base, notes)
    assert seen == [before] and versions_of(spark, lake) == WHOLE
    assert sorted(r.business_id for r in opened.collect()) == [v[0] for v in before]


def test_without_the_mark_of_the_committer(spark, lake):
    """The pointer says that a run is whole; the file that Spark leaves by default is not needed."""
    setting = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    spark._jsc.hadoopConfiguration().set(setting, "false")
    try:
        build_dimension(spark, lake, SPEC, SECOND)
    finally:
        spark._jsc.hadoopConfiguration().unset(setting)
    assert versions_of(spark, lake) == WHOLE


def test_old_versions_go_with_the_folders_that_only_they_have(spark, lake):
    path = lake.silver(SPEC.table)
    for n in range(2, 9):
        build_dimension(spark, lake, SPEC, LoadContext(2, date(2020, 2, n)), after_load=1)
    assert [n for n in sorted(os.listdir(f"{path}/_pointers")) if n.isdigit()] == [f"{n:010d}" for n in (6, 7, 8)]
    live = versions.live(spark, path)
    # The first load closes a version of "b"; its partition stays with the run that wrote it.
    assert sorted(f.split("/", 1)[1] for f in live.folders) == [
        "is_current=false/effective_to=2020-02-01", "is_current=true/effective_to=9999-12-31",
    ]
    kept = {f for n in (6, 7, 8) for f in versions._version(spark, path, n).folders}
    assert folders(path) == sorted({f.split("/")[0] for f in kept}) and len(folders(path)) == 4


def test_numbers_come_from_the_mark_and_are_never_used_twice(spark, lake):
    """The whole history lies in the table, but no column of it is read."""
    path = lake.silver(SPEC.table)
    assert versions.live(spark, path).notes["highest"] == {"business_id": 2 + 1}
    build_dimension(spark, lake, SPEC, SECOND)
    assert versions.live(spark, path).notes["highest"] == {"business_id": 5}
    delta, base, marks = second_delta(spark, lake)
    assert marks == {"business_id": 5}
    current, _ = standing(spark, path, base, SPEC)
    arriving = SPEC.conform(read_table(spark, lake.bronze("business"), "orc", raw_schema("business")).limit(0))
    scans = [part for part in formatted(delta).split("Scan parquet")[1:] if "PartitionFilters: [" in part]
    assert scans and all("is_current" in s.split("PartitionFilters: [")[1].split("]")[0] for s in scans)
    # Without the mark a column of all versions is read.
    assert "Subquery" not in formatted(delta) and "Subquery" in formatted(scd2_delta(current, arriving, SPEC, SECOND))
    publish_dimension(delta, path, base=base)  # notes no marks
    current, marks = standing(spark, path, versions.live(spark, path), SPEC)
    assert marks == {"business_id": 5}


def test_unchanged_members_are_matched_by_key_and_digest(spark, lake):
    spec, path = replace(SPEC, digests=True), lake.silver(SPEC.table)
    build_dimension(spark, lake, spec, SECOND)  # over a table without them
    assert versions_of(spark, lake) == WHOLE
    build_dimension(spark, lake, spec, LoadContext(2, date(2020, 3, 1)))
    assert versions_of(spark, lake) == WHOLE
    current, _ = standing(spark, path, versions.live(spark, path), spec)
    increment = current.filter("is_current").select(*SPEC.key_names, *SPEC.attribute_names)
    plan = formatted(new_and_changed(current, increment))
    scans = [part for part in plan.split("ReadSchema: ")[1:]]
    narrow = [s.split("\n")[0] for s in scans if "business_name" not in s.split("\n")[0]]
    assert narrow and all(DIGEST in s for s in narrow)
    wide = changed_rows(current.drop(DIGEST), increment, SPEC)
    assert all("business_name" in s.split("\n")[0] for s in formatted(wide).split("ReadSchema: ")[1:])
    other = increment.withColumn("business_stars", F.when(F.col("business_nk") == "a", None).otherwise(F.col("business_stars")))
    for rows, expected in ((increment, []), (other, ["a"])):
        for dim in (current, current.drop(DIGEST)):
            assert [r.business_nk for r in changed_rows(dim, rows, SPEC).collect()] == expected


def new_and_changed(current, increment):
    return changed_rows(current, increment, SPEC).select("business_id")


def test_digests_tell_what_comparison_tells(spark):
    rows = [(1.5, "a", None), (-0.0, "", "x"), (0.0, "", "x"), (float("nan"), None, ""), (float("nan"), None, None), (None, "2:ab", "-"), (None, "2", ":ab-")]
    spec = DimSpec("t", "t", ("i",), (Field("k", T.LongType(), "k"),), (
        Field("d", T.DoubleType(), "d"), Field("s", T.StringType(), "s"), Field("u", T.StringType(), "u")))
    df = spark.createDataFrame(rows, "d double, s string, u string").withColumn("h", spec.digest())
    left, right = df.alias("l"), df.alias("r")
    same = F.col("l.d").eqNullSafe(F.col("r.d")) & F.col("l.s").eqNullSafe(F.col("r.s")) & F.col("l.u").eqNullSafe(F.col("r.u"))
    pairs = left.join(right, F.lit(True)).select(same.alias("same"), (F.col("l.h") == F.col("r.h")).alias("digest"))
    found = pairs.collect()
    assert len(found) == 49 and all(r.same == r.digest for r in found) and sum(r.same for r in found) == 9


def test_a_table_without_pointers_is_adopted(spark, tmp_path):
    path = str(tmp_path / "dim")
    rows = spark.range(6).selectExpr("id", "id < 4 AS is_current", "if(id < 4, DATE '9999-12-31', date_add(DATE '2020-01-01', int(id))) AS effective_to")
    rows.write.partitionBy(*DIMENSION).parquet(path)
    with pytest.raises(versions.Conflict, match="adopt"):
        publish_dimension(rows, path)
    versions.adopt(spark, path, DIMENSION)
    versions.adopt(spark, path, DIMENSION)
    schema = "id long, is_current boolean, effective_to date"
    assert sorted(r.id for r in read_table(spark, path, schema=schema).collect()) == [0, 1, 2, 3, 4, 5]
    publish_dimension(rows.filter("id < 2"), path)
    assert sorted(r.id for r in read_table(spark, path, schema=schema).collect()) == [0, 1, 4, 5]
    versions.adopt(spark, str(tmp_path / "nowhere"), DIMENSION)
    assert versions.live(spark, str(tmp_path / "nowhere")) is None


def test_a_mart_survives_a_failed_rebuild(spark, tmp_path):
    path = str(tmp_path / "mart")
    spark.range(3).write.parquet(path)  # as a lake without pointers has it
    overwrite_table(spark.range(5), path)
    assert read_table(spark, path).count() == 5 and [n for n in os.listdir(path) if n.endswith(".parquet")] == []
    opened = read_table(spark, path)
    with pytest.raises(Exception, match="no"):
        overwrite_table(spark.range(100).selectExpr("if(id = 77, raise_error('no'), id) AS id"), path)
    assert sorted(r.id for r in read_table(spark, path).collect()) == list(range(5))
    overwrite_table(spark.range(2), path)
    assert read_table(spark, path).count() == 2 and opened.count() == 5
    overwrite_table(spark.range(0), path)
    assert read_table(spark, path).collect() == []


def test_balanced_files_follow_the_bytes(spark, tmp_path):
    """One huge partition and many tiny ones."""
    sized = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k", "spark.sql.shuffle.partitions": "40"}
    was = {k: spark.conf.get(k) for k in sized}
    rows = spark.range(0, 240_000, 1, 12).selectExpr("id", "uuid() AS text", "if(id % 60 > 0, 0, 1 + id % 300) AS p")
    counts = {}
    for key, value in sized.items():
        spark.conf.set(key, value)
    try:
        for files_asked in (None, "balanced"):
            path = str(tmp_path / str(files_asked))
            replace_partitions(rows, path, ["p"], files=files_asked)
            counts[files_asked] = {n: len([f for f in os.listdir(f"{path}/{n}") if f.endswith(".parquet")]) for n in os.listdir(path) if n[:2] == "p="}
    finally:
        for key, value in was.items():
            spark.conf.set(key, value)
    assert len(counts["balanced"]) == 6 == len(counts[None])
    tiny = {n: c for n, c in counts["balanced"].items() if n != "p=0"}
    assert set(counts[None].values()) == {12} and set(tiny.values()) == {1} and counts["balanced"]["p=0"] > 4


def test_intermediate_tables_go(spark, lake):
    before = set(files.children(spark, shared_folder(spark)))
    build_dimension(spark, lake, SPEC, SECOND)
    assert set(files.children(spark, shared_folder(spark))) == before
    with pytest.raises(ZeroDivisionError), scratch(spark):
        materialise(spark.range(3), "x")
        raise ZeroDivisionError
    assert set(files.children(spark, shared_folder(spark))) == before


def test_a_temporary_folder_of_the_machine_is_refused_on_a_cluster():
    for folder in ("file:///tmp/x", "file:/var/tmp"):
        with pytest.raises(RuntimeError, match="temporary folder"):
            shared_folder(Session("spark://host:7077", {CHECKPOINT_DIR: folder}))
    for master, folder in [("yarn", "file:///mnt/shared"), ("yarn", "/tmp/on-hdfs"), ("local-cluster[3,2,900]", "file:///tmp/x")]:
        assert shared_folder(Session(master, {CHECKPOINT_DIR: folder})) == folder


def test_a_load_run_again_without_rows_leaves_none(spark, lake, tmp_path):
    build_dimension(spark, lake, SPEC, SECOND)
    for load in (FIRST, SECOND):
        build_dimensions_and_facts(spark, lake, load)
    assert newest_fact(spark, lake, "fact_tips").count() == 1
    land(tmp_path / "landing2", "tip", [])
    ingest_load(spark, lake, SECOND, str(tmp_path / "landing2"), entities=["tip"])
    build_facts(spark, lake, SECOND)
    assert [r.ctl_loading for r in read_table(spark, lake.bronze("tip"), "orc").collect()] == [1]
    assert [r.ctl_loading for r in read_fact(spark, lake, "fact_tips").collect()] == [1]
    assert [r.ctl_loading for r in newest_fact(spark, lake, "fact_tips").collect()] == [1]


def build_dimensions_and_facts(spark, lake, load):
    from tidemark.entities import DIM_USERS

    build_dimension(spark, lake, DIM_USERS, load)
    build_facts(spark, lake, load)


def test_newest_load_is_found_by_folder(spark, lake):
    build_dimensions_and_facts(spark, lake, FIRST)
    build_dimensions_and_facts(spark, lake, SECOND)
    for table in ("fact_reviews", "fact_checkins", "fact_tips"):
        plan = formatted(newest_fact(spark, lake, table))
        assert "PartitionFilters: [isnotnull(ctl_loading_date" in plan and "2020-02-01" in plan
    assert {r.ctl_loading for r in newest_fact(spark, lake, "fact_reviews").collect()} == {2}
    assert files.newest_partition(spark, lake.silver("nowhere"), "x") is None


def test_facts_over_several_loads_take_the_newest_row(spark, lake):
    build_dimension(spark, lake, SPEC, SECOND)
    build_dimensions_and_facts(spark, lake, SECOND)
    build_facts(spark, lake, SECOND, after_load=0)
    stars = sorted(r.review_stars for r in read_fact(spark, lake, "fact_reviews").collect())
    assert stars == [4.0, 4.0]
    assert sum(r.cnt_appearance for r in read_fact(spark, lake, "fact_checkins").collect()) == 4
    assert [r.tips_sum_of_compliments for r in read_fact(spark, lake, "fact_tips").collect()] == [2]


def test_bronze_keeps_all_and_facts_leave_broken_lines(spark, lake, tmp_path):
    folder = tmp_path / "landing3"
    folder.mkdir()
    lines = [
        json.dumps(review("a", "u", "2019-12-02", 4.0) | {"mood": "good", "tags": ["x", 1]}),
        json.dumps(review("b", "u", "2019-12-02", 4.0) | {"useful": "many"}),
        "", "no json", "[1, 2]", json.dumps(review("b", None, "someday", 1.0)),
    ]
    (folder / f"{FILE_PREFIX}review.json").write_text("\n".join(lines))
    ingest_load(spark, lake, SECOND, str(folder), entities=["review"])
    bronze = read_table(spark, lake.bronze("review"), "orc").filter("ctl_loading = 2").collect()
    by_line = {(r[CORRUPT_RECORD] or "")[:7]: r for r in bronze}
    assert len(bronze) == 5 and by_line["no json"][EXTRA_FIELDS] is None and by_line["[1, 2]"].review_id is None
    extra = next(r[EXTRA_FIELDS] for r in bronze if r[EXTRA_FIELDS])
    assert extra == {"mood": "good", "tags": '["x",1]'}
    found = [r.asDict() for r in read_quality(spark, lake).filter("entity = 'review' AND ctl_loading = 2").collect()]
    assert [{k: r[k] for k in ("lines", "broken", "misfit", "null_keys", "bad_dates")} for r in found] == [
        {"lines": 5, "broken": 2, "misfit": 1, "null_keys": 1, "bad_dates": 1}
    ]
    build_dimension(spark, lake, SPEC, SECOND)
    build_dimensions_and_facts(spark, lake, SECOND)
    reviews = read_fact(spark, lake, "fact_reviews").collect()
    assert len(reviews) == 3 and sorted(r.review_useful_cnt is None for r in reviews) == [False, False, True]
    checkins = read_quality(spark, lake).filter("entity = 'checkin'").orderBy("ctl_loading").collect()
    assert [(r.lines, r.bad_dates) for r in checkins] == [(1, 1), (1, 1)]


def test_command_line_runs_one_table_with_file_counts(spark, lake, tmp_path):
    common = ["--root", lake.root, "--ctl_loading", "2", "--ctl_loading_date", str(SECOND.load_date)]
    main(["silver", *common, "--table", "dim_businesses", "--table", "dim_users", "--files", "1", "--workers", "2"], spark)
    assert versions_of(spark, lake) == WHOLE
    assert not os.path.exists(lake.silver("fact_tips"))
    current = [f for f in versions.live(spark, lake.silver(SPEC.table)).folders if "is_current=true" in f]
    assert len([f for f in os.listdir(f"{lake.silver(SPEC.table)}/{current[0]}") if f.endswith(".parquet")]) == 1
    main(["silver", *common, "--table", "fact_reviews", "--after_load", "0"], spark)
    assert read_fact(spark, lake, "fact_reviews").count() == 2
    build_facts(spark, lake, SECOND)
    main(["gold", *common, "--fill_idle_weeks", "--files", "2"], spark)
    filled = read_table(spark, lake.gold())
    assert filled.filter("weekly_tips_cnt IS NULL").count() == 0
    build_mart(spark, lake)
    assert read_table(spark, lake.gold()).filter("weekly_tips_cnt IS NULL").count() > 0


def test_command_line_refuses_tables_of_other_steps():
    base = ["--root", "r", "--ctl_loading", "1", "--ctl_loading_date", "2020-01-01"]
    for argv in [["gold", *base, "--table", "dim_users"], ["all", *base, "--landing", "l", "--table", "tip"],
                 ["all", *base, "--landing", "l", "--after_load", "0"]]:
        with pytest.raises(SystemExit):
            arguments(argv)
    assert arguments(["bronze", *base, "--landing", "l", "--table", "tip"]).table == ["tip"]


def test_jobs_that_have_not_begun_do_not_begin_after_a_failure(spark):
    ran = []

    def fail():
        raise ValueError("first")

    with pytest.raises(ValueError, match="first"):
        run_jobs(spark, [fail, *[lambda n=n: ran.append(n) or spark.range(10).count() for n in range(40)]], workers=1)
    assert len(ran) < 40


def test_null_sentinels_reach_the_merge(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    for n, load in [(1, FIRST), (2, SECOND)]:
        folder = tmp_path / f"s{n}"
        land(folder, "business", [business("a", 4.0) | {"city": "" if n == 2 else None}])
        ingest_load(spark, lake, load, str(folder), entities=["business"])
        build_dimension(spark, lake, SPEC, load, null_sentinels=True)
    assert [v[0] for v in versions_of(spark, lake)] == [1]
