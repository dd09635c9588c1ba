"""Loads that appear all at once, deletes that rewrite single files, and content checks."""

import datetime
import hashlib
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tunehouse.plans import publish as P
from tunehouse.sinks import manifests as M
from tunehouse.plans.checks import check_contents
from tunehouse.plans.load import check_loaded, check_loaded_contents
from tunehouse.plans.warehouse import Warehouse
from tunehouse.staging import Staging

SMALL = "/root/testdata/sf0.001"


def warehouse(spark, day=28):
    return Warehouse(Staging(spark, SMALL), datetime.date(2024, 2, day))


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("published"))
    assert P.publish(warehouse(spark), folder) == 1
    return folder


def folders(root):
    return sorted(str(p.relative_to(root)) for p in Path(root).rglob("*") if not p.name.startswith((".", "_SUCCESS")))


def test_tables_equal_what_was_built(spark, root):
    wh = warehouse(spark)
    published = P.PublishedWarehouse(spark, root, 1, wh)
    assert rows(published.customer()) == rows(wh.customer())
    assert rows(published.invoice("invoiceid", "total")) == rows(wh.invoice("invoiceid", "total"))
    assert {r["violations"] for r in check_loaded(published).collect()} == {0}
    found = check_loaded_contents(published).collect()
    assert {r["violations"] for r in found} == {0} and len({r["table_name"] for r in found}) == 7


def test_a_load_that_fails_at_one_table_changes_none(spark, root):
    before, at = folders(root), P.PublishedWarehouse(spark, root)
    old = rows(at.invoice("invoiceid"))

    class Failing(Warehouse):
        def currencies(self):
            return super().currencies().withColumn("usd_price", F.raise_error(F.lit("table 5 fails")))

    with pytest.raises(Exception, match="table 5 fails"):
        P.publish(Failing(Staging(spark, SMALL), datetime.date(2024, 2, 28)), root)
    assert [f for f in folders(root) if not f.endswith(".claim")] == [f for f in before if not f.endswith(".claim")]
    after = P.PublishedWarehouse(spark, root)
    assert after.manifest == at.manifest and rows(after.invoice("invoiceid")) == old


def test_no_reader_sees_a_half_written_load(spark, root, monkeypatch):
    known = M.loads(spark, root)
    seen = []
    real = M.announce
    monkeypatch.setattr(P, "announce", lambda *a: (seen.append(M.manifest(spark, root)["load"]), real(*a)))
    number = P.publish(warehouse(spark, 27), root)
    assert seen == [known[-1]] and M.manifest(spark, root)["load"] == number > known[-1]


def test_older_loads_stay_readable_until_they_expire(spark, tmp_path):
    root = str(tmp_path)
    first, second, third = (P.publish(warehouse(spark, d), root) for d in (26, 27, 28))
    old = P.PublishedWarehouse(spark, root, first)
    assert rows(old.playlist()) == rows(P.PublishedWarehouse(spark, root, third).playlist())
    assert M.expire(spark, root, keep=2) == [first]
    assert M.loads(spark, root) == [second, third]
    with pytest.raises(FileNotFoundError):
        P.PublishedWarehouse(spark, root, first)
    assert not list(tmp_path.glob(f"*/load-{first:012d}"))
    assert P.PublishedWarehouse(spark, root, second).track().count() > 0
    with pytest.raises(ValueError):
        M.expire(spark, root, keep=0)


def test_nothing_published(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        P.PublishedWarehouse(spark, str(tmp_path))


def test_two_writers_get_two_numbers(spark, tmp_path):
    assert [M.claim(spark, str(tmp_path)) for _ in range(3)] == [1, 2, 3]
    assert M.loads(spark, str(tmp_path)) == []


def in_files(spark, root, frame):
    """Publish one table with a file per value of ``part``."""
    number = M.claim(spark, root)
    folder = f"{root}/t/load-{number:012d}"
    frame.repartitionByRange(4, "part").write.parquet(folder)
    M.announce(spark, root, number, {"t": {"paths": [folder], "schema": frame.schema.jsonValue()}})


def digests(root):
    return {p: hashlib.sha256(p.read_bytes()).hexdigest() for p in Path(root).rglob("part-*.parquet")}


def test_delete_rewrites_only_files_with_a_hit(spark, tmp_path):
    root = str(tmp_path)
    frame = spark.range(1000).selectExpr("id", "id div 250 as part", "if(id % 7 = 0, null, id % 5) as v")
    in_files(spark, root, frame)
    before = digests(root)
    number = P.delete_rows(spark, root, "t", (F.col("part") == 2) & (F.col("v") == 3))
    assert {p: d for p, d in digests(root).items() if p in before} == before
    paths = M.manifest(spark, root)["tables"]["t"]["paths"]
    assert len([p for p in paths if p.endswith(".parquet")]) == 3 and len(paths) == 4
    want = rows(frame.where("not (part = 2 and v = 3) or v is null"))
    assert rows(M.read_entry(spark, M.manifest(spark, root)["tables"]["t"])) == want
    assert rows(M.read_entry(spark, M.manifest(spark, root, number - 1)["tables"]["t"])) == rows(frame)
    # again: files of both loads are kept, rewritten or left
    P.delete_rows(spark, root, "t", F.col("id") < 10)
    P.delete_rows(spark, root, "t", F.col("id") == 600)
    left = rows(frame.where("(not (part = 2 and v = 3) or v is null) and id >= 10 and id != 600"))
    assert rows(M.read_entry(spark, M.manifest(spark, root)["tables"]["t"])) == left
    M.expire(spark, root, keep=1)
    assert rows(M.read_entry(spark, M.manifest(spark, root)["tables"]["t"])) == left
    named = M.manifest(spark, root)["tables"]["t"]["paths"]
    files = [p for p in digests(root)]
    assert len(files) < len(before) + 4 and all(any(str(f).endswith(n.rsplit("/t/")[-1]) or n.rsplit("/t/")[-1] in str(f) for n in named) for f in files)


def test_delete_of_nothing_and_of_everything(spark, tmp_path):
    root = str(tmp_path)
    frame = spark.range(100).selectExpr("id", "id div 25 as part")
    in_files(spark, root, frame)
    before = digests(root)
    P.delete_rows(spark, root, "t", F.lit(None).cast("boolean"))
    assert digests(root) == before and M.read_entry(spark, M.manifest(spark, root)["tables"]["t"]).count() == 100
    P.delete_rows(spark, root, "t", F.lit(True))
    assert M.read_entry(spark, M.manifest(spark, root)["tables"]["t"]).count() == 0
    P.delete_rows(spark, root, "t", F.lit(True))
    assert M.read_entry(spark, M.manifest(spark, root)["tables"]["t"]).count() == 0


# ---- contents

TABLE = "id bigint, name string, price decimal(10,2), day date"
DAY = datetime.date(2024, 1, 1)


def _exact(row):
    return tuple(Decimal(v) if i == 2 and isinstance(v, int) else v for i, v in enumerate(row))


def found(spark, a, b, schema=TABLE, key=("id",)):
    left, right = (spark.createDataFrame([_exact(r) for r in x], t) for x, t in ((a, TABLE), (b, schema)))
    result = check_contents({"t": (left, right, key)}).collect()
    assert {r["staged_rows"] for r in result} <= {len(a), 0} or len(result) > 5
    return {r["column_name"]: r["violations"] for r in result if r["violations"]}


ROWS = [(1, "a", 1, DAY), (2, "b", 2, None), (3, None, None, DAY), (4, "b", 2, DAY)]


def test_order_does_not_matter(spark):
    assert found(spark, ROWS, ROWS[::-1]) == {}


def test_one_value_is_noticed_and_named(spark):
    assert found(spark, ROWS, [(1, "x", 1, DAY), *ROWS[1:]]) == {"name": 1, "*": 1}
    assert found(spark, ROWS, [(1, None, 1, DAY), *ROWS[1:]]) == {"name": 1, "*": 1}


def test_values_that_changed_rows_are_noticed(spark):
    swapped = [(1, "b", 1, DAY), (2, "a", 2, None), *ROWS[2:]]
    assert found(spark, ROWS, swapped) == {"name": 1, "*": 1}
    assert found(spark, ROWS, swapped, key=()) == {"*": 1}


def test_null_and_empty_differ(spark):
    assert found(spark, ROWS, [*ROWS[:2], (3, "", None, DAY), ROWS[3]]) == {"name": 1, "*": 1}


def test_repeated_rows_count(spark):
    assert found(spark, [*ROWS, ROWS[0], ROWS[0]], ROWS) == dict.fromkeys(["id", "name", "price", "day", "*"], 2)
    pair = [ROWS[0], ROWS[0]]
    assert found(spark, pair, [ROWS[1], ROWS[1]], key=()) == dict.fromkeys(["id", "name", "price", "day", "*"], 1)


def test_other_columns_and_types_are_named(spark):
    assert found(spark, ROWS, [r[:3] for r in ROWS], "id bigint, name string, price decimal(10,2)")["day"] >= 1
    texts = [(r[0], r[1], None if r[2] is None else str(r[2]), r[3]) for r in ROWS]
    assert "price" in found(spark, ROWS, texts, "id bigint, name string, price string, day date")


def test_empty_tables(spark):
    assert found(spark, [], []) == {}


def test_each_side_is_scanned_once_without_shuffling_rows(spark):
    frame = spark.range(10).selectExpr("id", "cast(id as string) as name")
    plan = check_contents({"t": (frame, frame, ("id",))})._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning(id" not in plan
