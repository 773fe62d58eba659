import pytest

from millrace.schemas import Field, TableSpec
from millrace.sinks.warehouse import Warehouse, Written

PLAIN = TableSpec("Plain", (Field("id", "bigint"), Field("v", "string")), id_col="id")
PARTED = TableSpec(
    "Parted", (Field("id", "bigint"), Field("v", "string"), Field("part", "string")), id_col="id",
    partition_col="part",
)


def put(warehouse, spec, data, parts=("",)):
    df = warehouse.spark.createDataFrame(data, spec.schema)
    version, rows, max_id = warehouse.write(spec, df, parts)
    return Written(spec.name, version, list(parts), rows, max_id)


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "warehouse")


def test_new_table_is_empty(spark, root):
    warehouse = Warehouse(spark, root)
    assert warehouse.snapshot(PLAIN).count() == 0
    assert warehouse.snapshot(PLAIN).columns == ["id", "v"]
    assert (warehouse.row_count(PLAIN), warehouse.next_id(PLAIN)) == (0, 1)


def test_writes_are_invisible_before_the_commit(spark, root, rows):
    warehouse = Warehouse(spark, root)
    first = put(warehouse, PLAIN, [(1, "a")])
    assert warehouse.snapshot(PLAIN).count() == 0
    warehouse.commit([first])
    assert rows(warehouse.snapshot(PLAIN)) == [(1, "a")]
    put(warehouse, PLAIN, [(1, "lost"), (2, "lost")])
    assert rows(Warehouse(spark, root).snapshot(PLAIN)) == [(1, "a")]
    warehouse.commit([put(warehouse, PLAIN, [(1, "b")])])
    assert rows(Warehouse(spark, root).snapshot(PLAIN)) == [(1, "b")]


def test_only_written_partitions_change(spark, root, rows):
    warehouse = Warehouse(spark, root)
    warehouse.commit([put(warehouse, PARTED, [(1, "a", "p"), (2, "b", "q"), (3, "c", "q")], ["p", "q"])])
    warehouse.commit([put(warehouse, PARTED, [(2, "B", "q"), (9, "d", "r")], ["q", "r"])])
    again = Warehouse(spark, root)
    for w in (warehouse, again):
        assert rows(w.snapshot(PARTED)) == [(1, "a", "p"), (2, "B", "q"), (9, "d", "r")]
        assert rows(w.snapshot(PARTED, ["q", "x"])) == [(2, "B", "q")]
        assert w.next_id(PARTED) == 10
    assert again.state(PARTED).versions == {"p": 1, "q": 2, "r": 2}


def test_partition_can_become_empty(spark, root, rows):
    warehouse = Warehouse(spark, root)
    warehouse.commit([put(warehouse, PARTED, [(1, "a", "p"), (2, "b", "q")], ["p", "q"])])
    version, _, _ = warehouse.write(PARTED, spark.createDataFrame([], PARTED.schema), ["p"])
    warehouse.commit([Written(PARTED.name, version, ["p"], empty=True)])
    assert rows(Warehouse(spark, root).snapshot(PARTED)) == [(2, "b", "q")]
    warehouse.commit([put(warehouse, PARTED, [(3, "c", "p")], ["p"])])
    assert rows(Warehouse(spark, root).snapshot(PARTED)) == [(2, "b", "q"), (3, "c", "p")]


def test_tables_are_committed_together(spark, root):
    warehouse = Warehouse(spark, root)
    written = [put(warehouse, PLAIN, [(1, "a")]), put(warehouse, PARTED, [(1, "a", "p")], ["p"])]
    assert Warehouse(spark, root).log().count() == 0
    warehouse.commit(written)
    again = Warehouse(spark, root)
    assert again.snapshot(PLAIN).count() == again.snapshot(PARTED).count() == 1


def test_ids_are_never_given_out_twice(spark, root):
    warehouse = Warehouse(spark, root)
    warehouse.commit([put(warehouse, PLAIN, [(7, "a")])])
    warehouse.commit([put(warehouse, PLAIN, [(1, "a")])])
    assert warehouse.next_id(PLAIN) == Warehouse(spark, root).next_id(PLAIN) == 8


def test_added_column_is_null_in_older_files(spark, root, rows):
    warehouse = Warehouse(spark, root)
    warehouse.commit([put(warehouse, PLAIN, [(1, "a")])])
    wider = TableSpec(PLAIN.name, (*PLAIN.fields, Field("RunID", "bigint")), id_col="id")
    assert rows(warehouse.snapshot(wider)) == [(1, "a", None)]


def test_pruned_partition_is_the_only_one_read(spark, root):
    warehouse = Warehouse(spark, root)
    warehouse.commit([put(warehouse, PARTED, [(1, "a", "p"), (2, "b", "q")], ["p", "q"])])
    files = warehouse.snapshot(PARTED).filter("part = 'q'").inputFiles()
    assert len(warehouse.snapshot(PARTED).inputFiles()) == 2 and files
    plan = warehouse.snapshot(PARTED).filter("part = 'q'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan


def test_batches_are_written_where_their_rows_are(spark, root):
    """No shuffle: every task that has rows writes its own file."""
    spec = TableSpec("Added", (*PARTED.fields, Field("b", "bigint")), id_col="id", partition_col="part", batch_col="b")
    warehouse = Warehouse(spark, root)
    df = spark.range(0, 100, 1, 4).selectExpr("id", "string(id) AS v", "'p' AS part", "1L AS b")
    attempt, found = warehouse.append(spec, df)
    assert (found["rows"], found["max_id"], found["parts"]) == (100, 99, ["p"])
    warehouse.commit([Written(spec.name, attempt, found["parts"], max_id=99, batch=1)])
    added = warehouse.added(spec)
    files = [name for name in added.inputFiles() if "/Added/part=p/" in name]
    assert added.count() == 100 and len(files) == 4 and all(".zstd." in name for name in files)
