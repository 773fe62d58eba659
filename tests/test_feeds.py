import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.sources.feeds import _ends_in_quotes, FeedError, choose_delimiter, read_feed, shape_feed


@pytest.fixture
def write(tmp_path):
    def to_file(text, name="feed.csv", encoding="utf-8"):
        path = tmp_path / name
        path.write_bytes(text.encode(encoding))
        return str(path)

    return to_file


def test_plain_feed_keeps_text_trims_header_and_selects(spark, write, rows):
    path = write('﻿a, b ,c,extra\r\n001,x y,3,q\r\n4,,NA,\r\n"x ""q"", z",n/a,<NA>,1\r\n')
    feed = read_feed(spark, path, ["c", "a", "b"])
    df = feed.checked()
    assert df.columns == ["c", "a", "b"]
    assert not feed.repaired
    assert {f.dataType.simpleString() for f in df.schema} == {"string"}
    assert rows(df) == [("3", "001", "x y"), (None, "4", None), (None, 'x "q", z', None)]


def test_na_tokens_match_whole_cells_only(spark, write, rows):
    path = write("a,b\n NA ,nanny\nNaN,NULL\nna,None\n")
    assert rows(read_feed(spark, path, ["a", "b"]).checked()) == [
        (" NA ", "nanny"), (None, None), ("na", None),
    ]
    assert rows(read_feed(spark, path, ["a", "b"], na_tokens=()).checked())[1] == ("NaN", "NULL")


def test_short_rows_are_filled(spark, write, rows):
    assert rows(read_feed(spark, write("a,b,c\n1\n4,5\n"), ["a", "b", "c"]).checked()) == [
        ("1", None, None), ("4", "5", None),
    ]


@pytest.mark.parametrize(
    "text", ["a,b\n1,2\n1,2,3\n", "a,b\n1,2,\n", "a,b\n1,2,3\n4,5,6\n", 'a,b\n1,2,"x,y"\n']
)
def test_wide_row_is_an_error(spark, write, text):
    with pytest.raises(FeedError, match="widest row"):
        read_feed(spark, write(text), ["a"]).checked()


def test_line_break_in_quotes(spark, write, rows):
    path = write('a,b\n1,"x\ny"\n')
    with pytest.raises(FeedError, match="multi_line"):
        read_feed(spark, path, ["a", "b"]).checked()
    assert rows(read_feed(spark, path, ["a", "b"], multi_line=True).checked()) == [("1", "x\ny")]


@pytest.mark.parametrize(
    "text, expected",
    [
        ('a,b\n1,"x\n2,y"\n3,4\n', [("1", "x\n2,y"), ("3", "4")]),
        ('"a,b,c"\n"A,South,x\ny"\n"B,West,z"\n', [("A", "South", "x\ny"), ("B", "West", "z")]),
    ],
)
def test_halves_of_the_right_width_are_not_taken_for_rows(spark, write, rows, text, expected):
    path, names = write(text), ["a", "b", "c"][: len(expected[0])]
    with pytest.raises(FeedError, match="[12] lines end within one"):
        read_feed(spark, path, names).checked()
    assert rows(read_feed(spark, path, names, multi_line=True).checked()) == expected


@pytest.mark.parametrize("header, other", [("a,a,b", "b,a,a"), ("a,,b", "b,,a")])
def test_made_up_names_do_not_hide_another_order(spark, write, tmp_path, rows, header, other):
    write(f"{header}\n1,2,3\n", "one.csv")
    write(f"{header}\r\n7,8,9\r\n", "same.csv")
    assert len(rows(read_feed(spark, str(tmp_path), ["a", "b"]).checked())) == 2
    write(f"{other}\n4,5,6\n", "two.csv")
    with pytest.raises(Exception, match="CSV header"):
        read_feed(spark, str(tmp_path), ["a", "b"]).checked()
    with pytest.raises(FeedError, match="2 different headers"):
        read_feed(spark, str(tmp_path), ["a", "b"], multi_line=True)


def test_quotes_within_a_field_are_text(spark, write, rows):
    path = write('a,b\n1,5" pipe\n2" x 4",board\n"3 ""ft""",6\'2"\n"",""\n"""",x"\n')
    want = [("1", '5" pipe'), ('"', 'x"'), ('2" x 4"', "board"), ('3 "ft"', "6'2\""), (None, None)]
    assert rows(read_feed(spark, path, ["a", "b"]).checked()) == sorted(want, key=lambda r: [str(x) for x in r])
    for text in ('a,b\n1,"5 pipe\n', 'a,b\n"1,""5"" pipe"",x\n', 'a,b\n5",""" open\n'):
        with pytest.raises(FeedError, match="1 lines end within one"):
            read_feed(spark, write(text), ["a", "b"]).checked()
    long = '"' + '""' * 50_000 + '"'
    assert rows(read_feed(spark, write(f"a,b\n1,{long}\n"), ["a", "b"]).checked()) == [("1", '"' * 50_000)]


def test_other_separators_open_fields_too(spark, write, rows):
    path = write('a|b\n"x|y"|5" pipe\n')
    assert rows(read_feed(spark, path, ["a", "b"], separator="|").checked()) == [("x|y", '5" pipe')]
    with pytest.raises(FeedError, match="1 lines end within one"):
        read_feed(spark, write('a|b\n1|"5\n'), ["a", "b"], separator="|").checked()


@pytest.mark.parametrize("encoding", ["windows-1252", "cp1250", "koi8-r", "mac-roman", "latin-1", "utf-8-sig"])
@pytest.mark.parametrize("multi_line", [False, True])
def test_any_encoding_of_one_byte(spark, write, rows, encoding, multi_line):
    letters = bytes(range(0xA1, 0x100)).decode(encoding if "utf" not in encoding else "latin-1", "replace")
    letters = letters.replace("\ufffd", "").replace("\x85", "").replace("\u2028", "")
    path = write(f'n,"{letters}"\n1,"{letters},q"\n', encoding=encoding)
    feed = read_feed(spark, path, [letters.strip(), "n"], encoding=encoding, multi_line=multi_line)
    assert rows(feed.checked()) == [(letters + ",q", "1")]


def test_encodings_of_several_bytes_name_the_setting(spark, write):
    path = write("a,b\n1,2\n")
    with pytest.raises(FeedError, match="spark.sql.legacy.javaCharsets"):
        read_feed(spark, path, ["a"], encoding="gbk")


def test_one_scan_reads_and_checks(spark, write):
    feed = read_feed(spark, write("a,b\n1,2\n"), ["a"])
    text = feed.df._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "Exchange" not in text


def test_header_with_marks_of_its_own(spark, write, rows):
    path = write('`a`,"b ""x"".c"\n1,2\n')
    assert rows(read_feed(spark, path, ['b "x".c', "`a`"]).checked()) == [("2", "1")]


def test_separator_and_encoding(spark, write, rows):
    path = write('Größe;b\n"x;y";1\n"ü ""q""";NA\n', encoding="latin-1")
    feed = read_feed(spark, path, ["Größe", "b"], separator=";", encoding="ISO-8859-1")
    assert not feed.repaired
    assert rows(feed.checked()) == [("x;y", "1"), ('ü "q"', None)]
    with pytest.raises(FeedError, match="widest row"):
        read_feed(spark, write("a;b\n1;2;3\n"), ["a"], separator=";").checked()


def test_missing_column_and_missing_file(spark, write, tmp_path):
    with pytest.raises(ValueError, match=r"lacks the columns \['z'\]; its header has \['a', 'b'\]"):
        read_feed(spark, write("a,b\n1,2\n"), ["a", "z"])
    with pytest.raises(AnalysisException):
        read_feed(spark, str(tmp_path / "none.csv"), ["a"])
    with pytest.raises(FeedError, match="no header"):
        read_feed(spark, write("", "empty.csv"), ["a"])


def test_repeated_header_name_keeps_the_first(spark, write, rows):
    assert rows(read_feed(spark, write("a,a,b\n1,2,3\n"), ["a", "b"]).checked()) == [("1", "3")]


def test_files_of_a_feed_must_agree_on_the_header(spark, write, tmp_path):
    write("a,b\n1,2\n", "one.csv")
    write("b,a\n3,4\n", "two.csv")
    with pytest.raises(Exception, match="CSV header"):
        read_feed(spark, str(tmp_path), ["a", "b"]).checked()


def test_wrapped_rows_are_split(spark, write, rows):
    path = write('"Name, Region ,Kind"\r\n"A,South,"\r\n"B,,x  <-- note"\r\n"C"\r\n')
    feed = read_feed(spark, path, ["Kind", "Name", "Region"])
    assert feed.repaired and feed.header_width == 3
    assert rows(feed.checked()) == [
        ("", "A", "South"), (None, "C", None), ("x  <-- note", "B", ""),
    ]


@pytest.mark.parametrize("delimiter", [";", "|"])
def test_other_delimiters(spark, write, rows, delimiter):
    path = write(f"a{delimiter}b\nNA{delimiter}2\n{delimiter}\n")
    assert rows(read_feed(spark, path, ["b", "a"]).checked()) == [("", ""), ("2", "NA")]


def test_delimiter_choice():
    assert choose_delimiter("a,b|c;d") == ";"
    assert choose_delimiter("a,b|c") == "|"
    assert choose_delimiter("a,b") == ","
    assert choose_delimiter("a") is None


@pytest.mark.parametrize(
    "text", ["a;b\n1;2;3\n", "a;b;c\n1;2\n3;4\n", "a;b\n1;2,3\n4;5\n", '"a,b"\n"1,2",3\n"4,5"\n']
)
def test_wrapped_rows_of_another_width_are_an_error(spark, write, text):
    with pytest.raises(FeedError, match="widest row"):
        read_feed(spark, write(text), ["a", "b"]).checked()


def test_shape_feed_renames(spark, rows):
    df = spark.createDataFrame([("1,2",), ("3,4",)], "`x,y` string")
    assert rows(shape_feed(df, ["y", "x"], ["second", "first"]).checked()) == [("2", "1"), ("4", "3")]
    assert shape_feed(df, ["y"], ["second"]).df.columns[0] == "second"
    with pytest.raises(ValueError, match="lacks the columns"):
        shape_feed(spark.createDataFrame([("1",)], "x string"), ["y"])


def test_lines_that_are_one_quoted_field(spark):
    lines = ['"a,b"', '""', '"', '"a', '"a"b"', 'a"b', '"a""b"', '"a","b', '"a","b"', 'x,"a', '"a"x,"b', "", '"é,ü"']
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string")
    opened = [r[0] for r in df.orderBy("i").select(_ends_in_quotes(F.col("line"), ",")).collect()]
    assert [x for x, o in zip(lines, opened) if o] == ['"', '"a', '"a","b', 'x,"a', '"a"x,"b']
