"""Versioned tables (FIXTURES F) and the gate-before-commit rule (C)."""

import pytest
from pyspark.sql import functions as F

from basketry.operators.quality import DataQualityError, Gates, enforce, gate_report
from basketry.sinks.versioned import SchemaMismatchError, VersionedTable, VersionNotFoundError

SCHEMA = "customer_id string, customer_unique_id string, customer_city string, customer_state string"


def _v0(spark, root):
    t = VersionedTable(spark, f"{root}/demo")
    df = spark.createDataFrame([(f"c{i}", f"u{i}", "sp", "SP") for i in range(5)], SCHEMA)
    t.overwrite(df)
    return t, df


def test_enforce_merge_as_of_rollback_history(spark, tmp_root):
    t, v0 = _v0(spark, tmp_root)
    bad = spark.createDataFrame([("c9", "u9", "rio", "RJ")], SCHEMA).withColumn("loyalty_points", F.lit(500))
    with pytest.raises(SchemaMismatchError):
        t.append(bad)
    assert t.latest_version() == 0

    assert t.append(bad, merge_schema=True) == 1
    cur = t.read()
    assert cur.count() == 6 and len(cur.columns) == 5
    assert cur.filter(F.col("loyalty_points").isNull()).count() == 5

    past = t.read(version=0)
    assert past.columns == v0.columns and sorted(past.collect()) == sorted(v0.collect())

    assert t.rollback(0) == 2
    assert sorted(t.read().collect()) == sorted(v0.collect())
    hist = [(r.version, r.operation) for r in t.history().collect()]
    assert hist == [(2, "RESTORE"), (1, "WRITE"), (0, "WRITE")]
    with pytest.raises(VersionNotFoundError):
        t.read(version=7)


def test_overwrite_schema_rules(spark, tmp_root):
    t, v0 = _v0(spark, tmp_root)
    narrow = v0.select("customer_id", F.lit(1).alias("customer_city"))  # type change
    with pytest.raises(SchemaMismatchError):
        t.overwrite(narrow)
    t.overwrite(narrow, overwrite_schema=True)
    assert t.read().columns == ["customer_id", "customer_city"]
    assert [r.operation for r in t.history().collect()] == ["WRITE", "WRITE"]


def test_append_missing_nullable_column_reads_null(spark, tmp_root):
    t, v0 = _v0(spark, tmp_root)
    t.append(v0.select("customer_id", "customer_unique_id"))
    assert t.read().filter(F.col("customer_city").isNull()).count() == 5


def test_failed_gate_commits_nothing(spark, tmp_root):
    t, v0 = _v0(spark, tmp_root)
    dup = v0.unionByName(v0)

    def check(written):
        enforce(gate_report(written, Gates(unique=(("customer_id",),)), "customers"))

    with pytest.raises(DataQualityError):
        t.overwrite(dup, check=check)
    assert t.latest_version() == 0 and t.read().count() == 5


def test_empty_table_version(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/empty")
    assert t.latest_version() is None
    t.overwrite(spark.createDataFrame([], SCHEMA))
    assert t.read().count() == 0


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

OPS = st.lists(
    st.tuples(st.sampled_from(["overwrite", "append", "merge", "rollback"]), st.integers(0, 3)),
    min_size=1,
    max_size=4,
)


@settings(max_examples=4, deadline=None)
@given(ops=OPS)
def test_versions_match_a_model(spark, tmp_path_factory, ops):
    """Random operation sequences: every version reads back exactly as modelled."""
    root = str(tmp_path_factory.mktemp("vt"))
    t = VersionedTable(spark, f"{root}/t")
    base = "k int, v string"
    model: list[tuple[list[str], list[tuple]]] = []  # per version: (columns, rows)
    t.overwrite(spark.createDataFrame([(0, "a")], base))
    model.append((["k", "v"], [(0, "a")]))
    for i, (op, arg) in enumerate(ops, start=1):
        cols, rows = model[-1]
        if op == "overwrite":
            new = [(i, f"o{j}") for j in range(arg)]
            t.overwrite(spark.createDataFrame(new, base).select(*[c for c in ["k", "v"]]))
            model.append((["k", "v"] + [c for c in cols if c not in ("k", "v")], [r[:2] + (None,) * (len(cols) - 2) for r in new]))
        elif op == "append":
            new = [(i, f"a{j}") for j in range(arg)]
            t.append(spark.createDataFrame(new, base))
            model.append((cols, rows + [r + (None,) * (len(cols) - 2) for r in new]))
        elif op == "merge":
            new = [(i, f"m{j}", i * 10) for j in range(arg)]
            df = spark.createDataFrame(new, "k int, v string, extra int")
            t.append(df, merge_schema=True)
            if "extra" in cols:
                model.append((cols, rows + new))
            else:
                model.append((cols + ["extra"], [r + (None,) for r in rows] + new))
        else:
            target = arg % len(model)
            t.rollback(target)
            model.append(model[target])
    assert t.versions() == list(range(len(model)))
    for version, (cols, rows) in enumerate(model):
        got = t.read(version=version)
        assert got.columns == cols, (version, ops)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(rows, key=repr), (version, ops)


def test_commit_recovers_from_crashed_record_and_detects_races(spark, tmp_root):
    import os

    from basketry.sinks.versioned import ConcurrentCommitError

    t, v0 = _v0(spark, tmp_root)
    # a crashed commit of version 1: folder with uncommitted debris only
    os.makedirs(f"{tmp_root}/demo/_commits/v{1:020d}/_temporary/0")
    assert t.latest_version() == 0
    assert t.append(v0) == 1 and t.read().count() == 10
    # a second writer that still believes version 0 is the latest
    stale = VersionedTable(spark, f"{tmp_root}/demo")
    old = t._record(0)
    stale._record = lambda version=None: old
    with pytest.raises(ConcurrentCommitError):
        stale.append(v0)
    assert t.read().count() == 10


def test_history_columns(spark, tmp_root):
    t, _ = _v0(spark, tmp_root)
    h = t.history()
    assert h.columns[:4] == ["version", "timestamp", "operation", "operationParameters"]
    row = h.collect()[0]
    assert row.timestamp is not None and row.operationParameters == {"mode": "Overwrite"}


def test_names_that_differ_in_case_are_one_column(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/case")
    t.overwrite(spark.createDataFrame([(1, "a")], "id int, v string"))
    t.append(spark.createDataFrame([(2, "b")], "ID int, v string"), merge_schema=True)
    t.append(spark.createDataFrame([(3, "c", 9)], "Id int, V string, w int"), merge_schema=True)
    got = t.read()
    assert got.columns == ["id", "v", "w"]
    assert sorted(map(tuple, got.collect())) == [(1, "a", None), (2, "b", None), (3, "c", 9)]
    t.overwrite(spark.createDataFrame([(4, "d")], "ID int, V string"))
    assert t.read().first().id == 4
    with pytest.raises(SchemaMismatchError):
        t.append(spark.createDataFrame([("x",)], "ID string"))


def test_two_instances_see_each_others_versions(spark, tmp_root):
    a, b = (VersionedTable(spark, f"{tmp_root}/two") for _ in range(2))
    df = spark.range(5)
    assert a.overwrite(df.limit(1)) == 0 and b.overwrite(df) == 1
    assert a.latest_version() == 1 and a.read().count() == 5
