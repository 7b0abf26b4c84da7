"""The merge: every case, the invariants over random loads, and what it must refuse."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import types as T

from tidemark.load import LoadContext
from tidemark.operators.scd2 import (
    changed_rows,
    expired_rows,
    new_key_rows,
    scd2_delta,
    scd2_merge,
    unaffected_rows,
)
from tidemark.sinks.writers import publish_dimension
from tidemark.sources.readers import empty_table, read_or_empty
from tidemark.specs import OPEN_END, DimSpec, Field

SPEC = DimSpec(
    "dim", "e", ("sk",),
    (Field("nk", T.StringType(), "id"),),
    (Field("name", T.StringType(), "name"), Field("score", T.DoubleType(), "score")),
)
DAYS = [date(2020, 1, 1) + timedelta(days=7 * i) for i in range(6)]
LOADS = [LoadContext(i + 1, day) for i, day in enumerate(DAYS)]
INCREMENT = "nk string, name string, score double"


def increment(spark, rows):
    return spark.createDataFrame(rows, INCREMENT)


def rows(dim):
    return sorted(tuple(r) for r in dim.select(*SPEC.columns).collect())


@pytest.fixture
def first(spark):
    """a stays, b changes, c goes missing; d has only a closed version."""
    current = [
        (1, "a", "A", 1.0, 1, DAYS[0], OPEN_END, True),
        (2, "b", "B", 2.0, 1, DAYS[0], OPEN_END, True),
        (3, "c", None, None, 1, DAYS[0], OPEN_END, True),
        (9, "d", "D", 4.0, 1, DAYS[0] - timedelta(days=9), DAYS[0] - timedelta(days=1), False),
    ]
    return spark.createDataFrame(current, SPEC.schema)


def test_all_cases(spark, first):
    arriving = increment(spark, [("a", "A", 1.0), ("b", "B", 2.5), ("d", "D", 4.0), ("e", None, None)])
    closed = DAYS[1] - timedelta(days=1)
    assert rows(scd2_merge(first, arriving, SPEC, LOADS[1])) == sorted(
        [
            (1, "a", "A", 1.0, 1, DAYS[0], OPEN_END, True),
            (2, "b", "B", 2.0, 2, DAYS[0], closed, False),
            (3, "c", None, None, 1, DAYS[0], OPEN_END, True),
            (9, "d", "D", 4.0, 1, DAYS[0] - timedelta(days=9), DAYS[0] - timedelta(days=1), False),
            (10, "b", "B", 2.5, 2, DAYS[1], OPEN_END, True),
            (11, "d", "D", 4.0, 2, DAYS[1], OPEN_END, True),
            (12, "e", None, None, 2, DAYS[1], OPEN_END, True),
        ]
    )


def test_parts_of_the_merge(spark, first):
    arriving = increment(spark, [("a", "A", 1.0), ("b", "B", 2.5), ("d", "D", 4.0), ("e", "E", None)])
    changed = changed_rows(first, arriving, SPEC)
    assert [tuple(r) for r in changed.collect()] == [(2, "b", "B", 2.5)]
    assert sorted(r.nk for r in new_key_rows(first, arriving, SPEC).collect()) == ["d", "e"]
    assert sorted(r.sk for r in unaffected_rows(first, changed, SPEC).collect()) == [1, 3, 9]
    expired = expired_rows(first, changed, SPEC, LOADS[1]).collect()
    assert [(r.sk, r.ctl_loading, r.effective_to, r.is_current) for r in expired] == [
        (2, 2, DAYS[1] - timedelta(days=1), False)
    ]


def test_delta_leaves_older_history_out(spark, first):
    delta = scd2_delta(first, increment(spark, [("b", "B", 2.5)]), SPEC, LOADS[1])
    assert sorted(r.sk for r in delta.collect()) == [1, 2, 3, 10]


def test_first_load_and_empty_increment(spark):
    nothing = empty_table(spark, SPEC.schema)
    dim = scd2_merge(nothing, increment(spark, [("b", "B", 1.0), ("a", "A", 1.0)]), SPEC, LOADS[0])
    assert [(r[0], r[1]) for r in rows(dim)] == [(1, "a"), (2, "b")]
    assert rows(scd2_merge(dim, increment(spark, []), SPEC, LOADS[1])) == rows(dim)
    assert rows(scd2_merge(nothing, increment(spark, []), SPEC, LOADS[0])) == []


def test_same_load_twice_changes_nothing(spark, first):
    arriving = increment(spark, [("a", "A2", 1.0), ("b", "B", 2.0), ("e", "E", None)])
    once = scd2_merge(first, arriving, SPEC, LOADS[1])
    assert rows(scd2_merge(once, arriving, SPEC, LOADS[1])) == rows(once)


def test_second_change_on_one_day_replaces_in_place(spark, first):
    once = scd2_merge(first, increment(spark, [("b", "B", 2.5), ("e", "E", 1.0)]), SPEC, LOADS[1])
    again = LoadContext(7, DAYS[1])
    twice = scd2_merge(once, increment(spark, [("b", "B", 3.0), ("f", "F", 1.0), ("a", "A2", 1.0)]), SPEC, again)
    by_sk = {r[0]: r for r in rows(twice)}
    assert by_sk[10][1:] == ("b", "B", 3.0, 7, DAYS[1], OPEN_END, True)
    assert by_sk[2][4:] == (2, DAYS[0], DAYS[1] - timedelta(days=1), False)
    assert by_sk[1][4:] == (7, DAYS[0], DAYS[1] - timedelta(days=1), False)
    assert (by_sk[12][1], by_sk[13][1]) == ("a", "f") and len(by_sk) == 8


def test_load_before_the_current_version_fails(spark, first):
    with pytest.raises(Exception, match="before the current version"):
        scd2_delta(first, increment(spark, [("b", "B", 9.0)]), SPEC, LoadContext(2, DAYS[0] - timedelta(days=1)))
    same = increment(spark, [("b", "B", 2.0)])
    assert rows(scd2_merge(first, same, SPEC, LoadContext(2, DAYS[0] - timedelta(days=3)))) == rows(first)


def test_null_keys_are_dropped(spark, first):
    arriving = increment(spark, [(None, "X", 1.0), (None, "Y", 1.0), ("a", "A", 1.0)])
    assert rows(scd2_merge(first, arriving, SPEC, LOADS[1])) == rows(first)


def test_two_rows_of_one_key_fail(spark, first):
    with pytest.raises(Exception, match="more than one row for key"):
        scd2_merge(first, increment(spark, [("a", "A", 1.0), ("a", "A", 2.0)]), SPEC, LOADS[1])


def test_null_sentinels(spark, first):
    arriving = increment(spark, [("c", "", 1.0)])
    assert len(rows(scd2_merge(first, arriving, SPEC, LOADS[1]))) == 5
    assert rows(scd2_merge(first, arriving, SPEC, LOADS[1], null_sentinels=True)) == rows(first)


def test_composite_keys_and_several_surrogates(spark):
    spec = DimSpec(
        "d", "e", ("s1", "s2"),
        (Field("k1", T.LongType(), "k1"), Field("k2", T.StringType(), "k2")),
        (Field("v", T.StringType(), "v"),),
    )
    schema = "k1 long, k2 string, v string"
    dim = scd2_merge(
        empty_table(spark, spec.schema), spark.createDataFrame([(1, "x", "p"), (1, "y", "q")], schema), spec, LOADS[0]
    )
    dim = scd2_merge(dim, spark.createDataFrame([(1, "x", "p2"), (2, "x", "r")], schema), spec, LOADS[1])
    got = sorted((r.s1, r.s2, r.k1, r.k2, r.v, r.is_current) for r in dim.collect())
    assert got == [
        (1, 1, 1, "x", "p", False), (2, 2, 1, "y", "q", True), (3, 3, 1, "x", "p2", True), (4, 4, 2, "x", "r", True),
    ]


def random_increment(rng, previous):
    """Keep, change, drop and add keys."""
    state = {}
    for key, (name, score) in previous.items():
        fate = rng.random()
        if fate < 0.15:
            continue
        state[key] = (name, score) if fate < 0.6 else (rng.choice([name, None, "", "n%d" % rng.randrange(9)]), rng.choice([score, None, 1.0]))
    for _ in range(rng.randrange(1, 12)):
        state.setdefault("k%03d" % rng.randrange(200), ("new", float(rng.randrange(5))))
    return state


def replay(history, state, load):
    """The same merge, key by key in Python."""
    fresh = []
    current = {r["nk"]: r for r in history if r["is_current"]}
    for key, (name, score) in sorted(state.items()):
        old = current.get(key)
        if old and (old["name"], old["score"]) == (name, score):
            continue
        if old:
            old.update(ctl_loading=load.load_id, effective_to=load.load_date - timedelta(days=1), is_current=False)
        fresh.append(
            {"nk": key, "name": name, "score": score, "ctl_loading": load.load_id, "effective_from": load.load_date,
             "effective_to": OPEN_END, "is_current": True}
        )
    top = max((r["sk"] for r in history), default=0)
    history.extend({"sk": top + i, **row} for i, row in enumerate(fresh, 1))


@pytest.mark.parametrize("seed", [1, 2])
def test_published_over_random_loads(spark, tmp_path, seed):
    rng, path = random.Random(seed), str(tmp_path / "dim")
    state, expected = {"k%03d" % i: ("n", 1.0) for i in range(40)}, []
    for n, load in enumerate(LOADS[:4]):
        state = state if n == 2 else random_increment(rng, state)  # the third load changes nothing
        arriving = increment(spark, [(k, *v) for k, v in state.items()])
        publish_dimension(scd2_delta(read_or_empty(spark, path, SPEC.schema), arriving, SPEC, load), path)
        replay(expected, state, load)
        dim = read_or_empty(spark, path, SPEC.schema)
        assert rows(dim) == sorted(tuple(r[c] for c in SPEC.columns) for r in expected)

    versions = defaultdict(list)
    for row in dim.collect():
        versions[row.nk].append(row)
    assert len({r.sk for v in versions.values() for r in v}) == dim.count()
    for of_key in versions.values():
        of_key.sort(key=lambda r: r.effective_from)
        assert [r.is_current for r in of_key] == [False] * (len(of_key) - 1) + [True]
        for one, two in zip(of_key, of_key[1:]):
            assert one.effective_to + timedelta(days=1) == two.effective_from


def test_publish_does_not_touch_older_history(spark, tmp_path):
    path = tmp_path / "dim"
    for n in range(3):
        arriving = increment(spark, [("a", f"v{n}", 1.0), ("b", "B", 1.0)])
        current = read_or_empty(spark, str(path), SPEC.schema)
        before = {p: p.stat().st_mtime_ns for p in path.glob("*/is_current=false/*/*.parquet")}
        publish_dimension(scd2_delta(current, arriving, SPEC, LOADS[n]), str(path))
        assert all(p.exists() and p.stat().st_mtime_ns == t for p, t in before.items())
    assert len(list(path.glob("*/is_current=false/*"))) == 2


def test_two_publishes_on_one_day_keep_all_closed_versions(spark, tmp_path):
    path = str(tmp_path / "dim")

    def load(number, day, arriving):
        delta = scd2_delta(read_or_empty(spark, path, SPEC.schema), increment(spark, arriving), SPEC, LoadContext(number, day))
        publish_dimension(delta, path)

    load(1, DAYS[0], [("a", "A", 1.0), ("b", "B", 1.0), ("c", "C", 1.0)])
    load(2, DAYS[1], [("a", "A2", 1.0)])
    load(3, DAYS[1], [("a", "A3", 1.0), ("b", "B3", 1.0)])
    got = [(r[0], r[1], r[2], r[4], r[7]) for r in rows(read_or_empty(spark, path, SPEC.schema))]
    assert got == [
        (1, "a", "A", 2, False), (2, "b", "B", 3, False), (3, "c", "C", 1, True),
        (4, "a", "A3", 3, True), (5, "b", "B3", 3, True),
    ]
