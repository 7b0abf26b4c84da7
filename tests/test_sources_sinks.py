from __future__ import annotations

from datetime import date

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.plans import formatted
from tidemark.entities import entity_spec
from tidemark.load import LoadContext, stamp
from tidemark.plans.lake import ingest
from tidemark.sinks.writers import _of_load, overwrite_table, publish_fact, replace_partitions, write_bronze
from tidemark.sources.readers import corrupt_rows, empty_table, read_entity, read_or_empty, read_table, since_load

LOADS = [LoadContext(1, date(2020, 1, 1)), LoadContext(2, date(2020, 1, 8))]


@pytest.fixture
def landing(tmp_path):
    lines = [
        '{"business_id": "b1", "name": "One", "stars": 4.5, "review_count": 3, "attributes": {"BusinessParking": "yes"}}',
        "{'business_id': 'b2', 'name': 'Two', 'hours': {'Monday': '9-17'}}",
        '{"business_id": "b3", "stars": "many"}',
        '{"business_id": ',
    ]
    (tmp_path / "yelp_academic_dataset_business.json").write_text("\n".join(lines))
    return str(tmp_path)


def test_json_entity_keeps_bad_lines(spark, landing):
    df = read_entity(spark, entity_spec("business"), landing)
    rows = {r.business_id: r for r in df.collect()}
    assert rows["b1"].stars == 4.5 and rows["b1"].review_count == 3
    assert rows["b2"].name == "Two" and rows["b2"].hours == {"Monday": "9-17"}
    assert rows["b3"].stars is None and rows["b3"]._corrupt_record == '{"business_id": "b3", "stars": "many"}'
    assert corrupt_rows(df.cache()).count() == 2
    parking = df.select("business_id", F.col("attributes.BusinessParking")).collect()
    assert dict((r[0], r[1]) for r in parking)["b1"] == "yes"


ODD_REVIEWS = [
    '{"review_id":"r1","stars":2.0,"useful":3,"text":"plain","date":"2001-02-03 04:05:06"}',
    '{"review_id": "r2", "stars": -1.5E3, "useful": null, "text": "a\\nb \\"c\\" \\u00e9\\u003a \\\\"}',
    '{"review_id":"r3","stars":3,"useful":0,"text":""}',
    '{"stars":2.0,"review_id":"out of order"}',
    '{"review_id":"r4","review_id":"twice"}',
    '{"review_id":"r5","more":"beyond","text":"x"}',
    '{"review_id":"r6","stars":"2.5","useful":"many"}',
    '{"review_id":"r7","stars":1.5E400,"useful":1.0}',
    '{"review_id":"r8","useful":99999999999999999999,"text":12.50}',
    '{"review_id":"r9","stars":-0,"useful":-0}',
    '{"review_id":"r10","useful":007}',
    '{"review_id":"r11","text":"\\q"}',
    '{"review_id":"r12","text":"tab\there"}',
    '{"review_id":"r13",}',
    '{"review_id":"r14" "text":"x"}',
    '{"review_id":"r15"',
    '[{"review_id":"r16"}]',
    "{'review_id':'r17'}",
    "{}",
]


def test_lines_cut_by_the_pattern_are_as_parsed(spark, monkeypatch):
    from tidemark.sources import readers

    spec = entity_spec("review")
    declared = [f for f in spec.schema if not f.name.startswith("_")]
    lines = spark.createDataFrame([(line,) for line in ODD_REVIEWS], "value string").coalesce(1)
    plain = lines.filter(F.col("value").rlike(readers.plain_line(declared)))
    assert [r.value for r in plain.collect()] == [*ODD_REVIEWS[:3], "{}"]
    cut = readers.parse_lines(lines, spec).collect()
    monkeypatch.setattr(readers, "plain_line", lambda fields: "(?!)")
    assert cut == readers.parse_lines(lines, spec).collect()
    assert cut[1].text == 'a\nb "c" \u00e9: \\' and cut[1].stars == -1500 and cut[5]._extra_fields == {"more": "beyond"}


def test_long_lines_are_cut_in_one_look(spark):
    from tidemark.sources.readers import parse_lines, plain_line

    spec = entity_spec("business")
    text, hours = '\\"a\\n' * 100_000, ",".join(f'"k{n}":"v"' for n in range(20_000))
    lines = spark.createDataFrame([(f'{{"name":"{text}","hours":{{{hours}}}}}',)], "value string")
    declared = [f for f in spec.schema if not f.name.startswith("_")]
    assert lines.filter(F.col("value").rlike(plain_line(declared))).count() == 1
    row = parse_lines(lines, spec).first()
    assert row.name == '"a\n' * 100_000 and len(row.hours) == 20_000 and row._corrupt_record is None


def test_both_landings_hold_the_same_days(spark, tmp_path):
    """Days are written out once, where lines and orders are joined."""
    from acceptance import star

    day = F.lit("1999-05-08 01:02:03.5").cast("timestamp_ntz")
    line = dict.fromkeys(("l_orderkey", "l_partkey", "l_suppkey"), F.lit(1)) | dict.fromkeys(
        ("l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"), F.lit(1)
    )
    flags = {"l_returnflag": F.lit("N"), "l_linestatus": F.lit("O"), "l_shipdate": F.when(F.col("id") > 0, day)}
    order = dict.fromkeys(("o_orderkey", "o_custkey"), F.lit(1)) | dict.fromkeys(
        ("o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"), F.lit(None)
    )
    for name, rows, made in (("lineitem", 2, line | flags), ("orders", 1, order)):
        schema = T._parse_datatype_string(star.SCHEMAS[name])
        table = spark.range(rows).select(*[made[f.name].cast(f.dataType).alias(f.name) for f in schema])
        table.write.parquet(str(tmp_path / f"{name}.parquet"))
    lines = star.ordered_lines(spark, str(tmp_path))
    assert {r.date for r in lines.collect()} == {None, "1999-05-08 01:02:03"}
    assert "date_format" not in formatted(star.raw_reviews(spark, str(tmp_path), lines.localCheckpoint()))


def test_inferred_schema_keeps_structs(spark, landing):
    df = read_entity(spark, entity_spec("business", declared=False), landing)
    assert df.schema["attributes"].dataType.simpleString() == "struct<BusinessParking:string>"


def test_ingest_keeps_all_columns_and_other_loads(spark, landing, tmp_path):
    bronze = str(tmp_path / "bronze")
    for load in LOADS:
        ingest(spark, [entity_spec("business")], load, landing, bronze, workers=2)
    table = read_table(spark, f"{bronze}/yelp_academic_dataset_business", "orc")
    assert {"attributes", "hours", "_corrupt_record", "ctl_loading", "ctl_loading_date"} <= set(table.columns)
    assert {(r[0], r[1]) for r in table.groupBy("ctl_loading").count().collect()} == {(1, 4), (2, 4)}
    assert "PartitionFilters: [isnotnull(ctl_loading" in formatted(since_load(table, 1))


def test_ingest_with_own_reader_and_failure(spark, tmp_path):
    bronze = str(tmp_path / "bronze")
    ingest(spark, [entity_spec("tip", "x_")], LOADS[0], "anywhere", bronze, reader=lambda s, spec, root: s.range(3))
    assert read_table(spark, f"{bronze}/x_tip", "orc").count() == 3
    with pytest.raises(AnalysisException):
        ingest(spark, [entity_spec("tip")], LOADS[0], str(tmp_path / "nowhere"), bronze)


def test_rewritten_load_replaces_only_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    write_bronze(stamp(spark.range(5), LOADS[0]), path, LOADS[0])
    write_bronze(stamp(spark.range(9), LOADS[1]), path, LOADS[1])
    write_bronze(stamp(spark.range(2), LOADS[1]), path, LOADS[1], files=1)
    counts = {r[0]: r[1] for r in read_table(spark, path, "orc").groupBy("ctl_loading").count().collect()}
    assert counts == {1: 5, 2: 2}


def test_fact_publish_leaves_session_conf_alone(spark, tmp_path):
    path = str(tmp_path / "f")
    for load, n in [(LOADS[0], 4), (LOADS[1], 6), (LOADS[1], 3)]:
        publish_fact(stamp(spark.range(n), load), path, load)
    table = read_table(spark, path)
    assert {r[0]: r[1] for r in table.groupBy("ctl_loading_date").count().collect()} == {
        date(2020, 1, 1): 4, date(2020, 1, 8): 3,
    }
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_rows_of_a_load_are_not_sorted_by_it(spark):
    load = LoadContext(1, date(2020, 1, 1))
    seen = stamp(spark.range(5), load).observe(Observation(), F.count(F.lit(1)).alias("rows"))
    assert "Sort" in formatted(seen.sort("ctl_loading"))
    assert "Sort" not in formatted(_of_load(seen, "ctl_loading", load.load_id).sort("ctl_loading"))


def test_landed_lines_are_compressed_in_bounded_files(spark, tmp_path, monkeypatch):
    from acceptance import queries

    monkeypatch.setattr(queries, "LINES_PER_FILE", 3)
    rows = spark.range(0, 10, 1, 1).select(F.col("id").cast("string").alias("business_id"), F.lit("2020-01-01").alias("date"))
    queries._land(rows, str(tmp_path), "checkin")
    spec = entity_spec("checkin")
    files = list((tmp_path / f"{spec.name}.json").glob("part-*"))
    assert len(files) == 4 and all(f.name.endswith(".json.gz") for f in files)
    landed = read_entity(spark, spec, str(tmp_path)).collect()
    assert sorted(int(r.business_id) for r in landed) == list(range(10))


def test_flag_partition_reads_back_boolean(spark, tmp_path):
    path, schema = str(tmp_path / "d"), "id long, is_current boolean"
    replace_partitions(spark.range(4).withColumn("is_current", F.col("id") > 1), path, ["is_current"])
    table = read_or_empty(spark, path, spark.createDataFrame([], schema).schema)
    assert dict(table.dtypes)["is_current"] == "boolean"
    current = table.filter(F.col("is_current"))
    assert sorted(r.id for r in current.collect()) == [2, 3]
    assert "PartitionFilters: [isnotnull(is_current" in formatted(current)


def test_table_is_replaced_by_a_plan_that_reads_it(spark, tmp_path):
    path = str(tmp_path / "d")
    replace_partitions(spark.range(4).withColumn("p", F.lit(1)), path, ["p"])
    replace_partitions(read_table(spark, path).withColumn("id", F.col("id") + 10), path, ["p"])
    assert sorted(r.id for r in read_table(spark, path).collect()) == [10, 11, 12, 13]


def test_overwrite(spark, tmp_path):
    path = str(tmp_path / "g")
    overwrite_table(spark.range(5), path)
    overwrite_table(spark.range(2), path, files=1)
    assert read_table(spark, path).count() == 2


def test_missing_table_is_empty_but_other_failures_are_raised(spark, tmp_path):
    schema = spark.range(1).schema
    assert read_or_empty(spark, str(tmp_path / "none"), schema).collect() == []
    with pytest.raises(AnalysisException, match="UNSUPPORTED_DATA_TYPE|schema"):
        read_or_empty(spark, str(tmp_path), schema, fmt="text")


def test_empty_table_vanishes_from_joins(spark):
    nothing = empty_table(spark, spark.range(1).schema)
    assert nothing.schema["id"].dataType.simpleString() == "bigint"
    assert "Join" not in formatted(spark.range(10).join(nothing, "id", "left"))
