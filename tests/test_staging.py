import pytest

from millrace.functions.coerce import coerce_types
from millrace.functions.keys import KeyRule
from millrace.operators.keyfilter import KeyColumns
from millrace.schemas import Field, TableSpec, text
from millrace.sinks import staging
from millrace.sinks.staging import (
    ROW_SEQUENCE, ContractError, contract_violations, export_jdbc, load_staging,
)
from millrace.sources.feeds import FeedError, read_feed

SPEC = TableSpec("Stg", (text("name", 5, required=True), text("note", 3), Field("n", "bigint", True)))


def frame(spark, data):
    return spark.createDataFrame(data, "name string, note string, n bigint")


def test_rows_are_replaced_counted_and_numbered(spark, tmp_path, rows):
    path = str(tmp_path / "stg")
    load_staging(frame(spark, [("old", None, 1)]), SPEC, path)
    staged = load_staging(frame(spark, [("a", "x", 1), ("b", None, 2), ("b", None, 2)]), SPEC, path)
    assert staged.rows == 3
    assert rows(staged.df, "name", "note", "n") == [("a", "x", 1), ("b", None, 2), ("b", None, 2)]
    sequence = [r[0] for r in staged.df.select(ROW_SEQUENCE).collect()]
    assert len(set(sequence)) == 3
    assert staged.partitions == max(s >> 33 for s in sequence) + 1


def test_empty_feed_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="empty"):
        load_staging(frame(spark, []), SPEC, str(tmp_path / "stg"))


def test_contract(spark, tmp_path, rows):
    bad = frame(spark, [("a", "toolong", None), (None, "ok", 1), ("abcdef", None, None)])
    with pytest.raises(ContractError) as error:
        load_staging(bad, SPEC, str(tmp_path / "stg"))
    for part in ("name is missing in 1", "name is longer than 5 in 1", "note is longer than 3 in 1",
                 "n is missing in 2"):
        assert part in str(error.value)
    assert rows(contract_violations(bad, SPEC)) == [
        ("n is missing", 2), ("name is longer than 5", 1), ("name is missing", 1),
        ("note is longer than 3", 1),
    ]


def test_width_is_checked_while_staging(spark, tmp_path):
    (tmp_path / "f.csv").write_text("name,note,n\na,b,1\na,b,2,3\n")
    feed = read_feed(spark, str(tmp_path / "f.csv"), SPEC.columns)
    typed = type(feed)(coerce_types(feed.df, {"n": "int"}), feed.header_width, feed.repaired)
    with pytest.raises(FeedError):
        load_staging(typed, SPEC, str(tmp_path / "stg"))


def test_frequent_keys_are_found_in_the_same_pass(spark, tmp_path):
    data = [("hot", "x", i) for i in range(400)] + [(f"n{i}", "x", i) for i in range(600)]
    probe = KeyColumns(("name",), ("name",), KeyRule())
    args = (frame(spark, data), SPEC, str(tmp_path / "stg"), {"name": probe})
    # The session has three shuffle partitions: from a twelfth of the rows on a key is hot.
    assert len(load_staging(*args).hot["name"]) == 1
    few = frame(spark, [(f"n{i % 20}", "x", i) for i in range(600)])
    assert load_staging(few, *args[1:]).hot["name"] == []


def test_jdbc_needs_a_driver(spark):
    with pytest.raises(Exception, match="(?i)driver"):
        export_jdbc(frame(spark, [("a", "b", 1)]), "jdbc:nosuch:db", "t")


def test_contract_is_one_flag_while_staging(spark, tmp_path, monkeypatch):
    """Metrics are not generated code: one per rule costs more than the rows."""
    seen = []
    write = staging.write_observed
    monkeypatch.setattr(staging, "write_observed", lambda df, path, metrics, **kw: seen.append(metrics) or write(df, path, metrics, **kw))
    staged = load_staging(frame(spark, [("a", "x", 1), ("abcde", None, 2)]), SPEC, str(tmp_path / "stg"))
    assert staged.rows == 2 and staged.df.columns == ["name", "note", "n", ROW_SEQUENCE]
    assert len(seen[0]) <= 3
