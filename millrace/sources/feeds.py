"""Delimited feeds read as text: header repair, missing values, row-width checks."""

from __future__ import annotations

import codecs
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from millrace.functions.text import NA_TOKENS, na_to_null

WIDTH = "_row_width"
#: The width of a line that ends within a quoted field.
OPEN = -1
_MALFORMED = "_malformed_line"
#: A character that no text holds: as a separator it leaves lines whole.
_NO_SEPARATOR = "\uffff"

# The character sets that Spark's reader takes, by the names Python knows them by.
_SPARK_ENCODINGS = {
    "utf-8": "UTF-8", "utf-8-sig": "UTF-8", "ascii": "US-ASCII", "iso8859-1": "ISO-8859-1",
    "utf-16": "UTF-16", "utf-16-be": "UTF-16BE", "utf-16-le": "UTF-16LE", "utf-32": "UTF-32",
}


def _named(name: str) -> Column:
    """The column of exactly this name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


class FeedError(ValueError):
    """The feed does not have the shape that was promised."""


@dataclass(frozen=True)
class Feed:
    """Text columns in the expected order, plus ``WIDTH``: the fields found in each row.

    The widths are checked from a metric gathered while the rows are written to staging,
    so that a feed is scanned once. ``checked()`` does it in a pass of its own.
    """

    df: DataFrame
    header_width: int
    repaired: bool

    @staticmethod
    def width_metric() -> Column:
        """The widest row, and the number of lines that end within a quoted field."""
        return F.struct(F.max(WIDTH).alias("widest"), F.count_if(F.col(WIDTH) == OPEN).alias("open"))

    def check_width(self, found: Row) -> None:
        if found["open"]:
            raise FeedError(
                f"a quoted field spans lines ({found['open']} lines end within one); "
                "read the feed with multi_line=True"
            )
        widest = found["widest"]
        if widest is None:
            return
        if widest > self.header_width or (self.repaired and widest != self.header_width):
            raise FeedError(f"widest row has {widest} fields, the header has {self.header_width}")

    def checked(self) -> DataFrame:
        # The parser cannot report malformed lines alone, so a value is counted along.
        value = F.count(_named(self.df.columns[0]))
        self.check_width(self.df.agg(self.width_metric(), value).first()[0])
        return self.df.drop(WIDTH)


def choose_delimiter(header: str) -> str | None:
    """The delimiter of a header that was read as one field; ``;`` beats ``|`` beats ``,``."""
    return next((d for d in (";", "|", ",") if d in header), None)


def require_columns(found: Sequence[str], expected: Sequence[str]) -> None:
    missing = [c for c in expected if c not in found]
    if missing:
        raise FeedError(f"the feed lacks the columns {missing}; its header has {list(found)}")


def shape_feed(
    df: DataFrame, expected: Sequence[str], new_names: Sequence[str] | None = None
) -> Feed:
    """Pick the expected columns, splitting rows that arrived as one field each.

    ``df`` may carry ``WIDTH``, the fields per row found by the reader. Inside a single
    field, quotes mean nothing: it is cut at every delimiter.
    """
    cells = [c for c in df.columns if c != WIDTH]
    width = F.col(WIDTH) if WIDTH in df.columns else F.lit(len(cells))
    delimiter = choose_delimiter(cells[0]) if len(cells) == 1 else None
    if delimiter is None:
        names = [c.strip() for c in cells]
        values = [_named(c) for c in cells]
    else:
        names = [part.strip() for part in cells[0].split(delimiter)]
        fields = F.split(_named(cells[0]), re.escape(delimiter), -1)
        values = [F.get(fields, position) for position in range(len(names))]
        # A row with several outer fields is too wide whatever its first field holds.
        width = (
            F.when(width == OPEN, width).when(width > 1, width + len(names)).otherwise(F.size(fields))
        )
    require_columns(names, expected)
    columns = [
        values[names.index(column)].alias(name)
        for column, name in zip(expected, new_names or expected, strict=True)
    ]
    return Feed(df.select(*columns, width.alias(WIDTH)), len(names), delimiter is not None)


def _unique_names(header: Sequence[str | None]) -> list[str]:
    """Names for the header cells; a repeated name gets a counter, a blank one its position."""
    seen: dict[str, int] = {}
    names = []
    for position, cell in enumerate(header):
        name = cell if cell else f"_c{position}"
        count = seen.get(name, 0)
        seen[name] = count + 1
        names.append(f"{name}.{count}" if count else name)
    return names


def _line_width(line: Column, header_width: int, separator: str) -> Column:
    """Fields in a row, exact for the lines that the parser gives back as of another width.

    Such a line is parsed again with one more column; the letter added at its end makes an
    empty last field visible.
    """
    wider = ", ".join(f"c{i} string" for i in range(header_width + 1))
    parsed = F.from_csv(F.concat(line, F.lit("x")), wider, {"escape": '"', "sep": separator})
    return (
        F.when(line.isNull(), F.lit(header_width))
        .when(parsed[f"c{header_width}"].isNotNull(), F.lit(header_width + 1))
        .otherwise(F.lit(header_width))
    )


def _ends_in_quotes(line: Column, separator: str) -> Column:
    """Whether a field that opens with a quote is still open at the end of the line.

    A quote elsewhere in a field, such as an inch mark, is text. Fields that close are taken out
    from left to right; what then opens does not close.
    """
    begin = f"(^|{re.escape(separator)})\""
    closed = F.regexp_replace(line, f'{begin}(?:[^"]++|"")*+"', "$1")
    # A line that is one quoted field without quotes in it needs no search from field to field.
    one_field = F.startswith(line, F.lit('"')) & (F.locate('"', line, 2) == F.char_length(line))
    return F.contains(line, F.lit('"')) & ~one_field & closed.rlike(begin)


def _decoding(spark: SparkSession, encoding: str) -> tuple[str, Callable[[Column], Column], Callable[[str], str]]:
    """The character set to read with, and how to get from there to the text, in both worlds.

    Sets of one byte per character that Spark does not know are read as ISO-8859-1, which keeps
    every byte, and translated; bytes without a meaning become the replacement character.
    """
    known = _SPARK_ENCODINGS.get(_codec(encoding))
    if known or spark.conf.get("spark.sql.legacy.javaCharsets", "false").lower() == "true":
        return known or encoding, lambda c: c, lambda text: text
    table = {}
    for byte in range(256):
        try:
            text = codecs.getincrementaldecoder(encoding)().decode(bytes([byte]))
        except UnicodeDecodeError:
            text = "\ufffd"
        if len(text) != 1 or (byte < 128 and text != chr(byte)):
            raise FeedError(
                f"{encoding} has characters of several bytes: set spark.sql.legacy.javaCharsets to true, "
                "which lets Spark read any character set of its Java version"
            )
        if text != chr(byte):
            table[chr(byte)] = text
    letters, meant = "".join(table), "".join(table.values())
    return "ISO-8859-1", lambda c: F.translate(c, letters, meant), lambda text: text.translate(str.maketrans(table))


def _codec(encoding: str) -> str:
    try:
        return codecs.lookup(encoding).name
    except LookupError:
        return encoding


def _check_headers(spark: SparkSession, path: str | list[str], options: dict[str, str]) -> None:
    """Whether all files have one header, where names were made up for it.

    The reader cannot compare such headers itself; a pass over the files does.
    """
    rows = spark.read.options(**options).csv(path)
    rows = rows.select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("place"),
        F.array(*[F.col(f"`{c}`") for c in rows.columns]).alias("cells"),
    )
    files = rows.groupBy("file").agg(F.min_by("cells", "place").alias("header"))
    headers = files.agg(F.count_distinct("header")).first()[0]
    if headers > 1:
        raise FeedError(f"the files have {headers} different headers with repeated or blank names")


def _read_lines(
    spark: SparkSession,
    path: str | list[str],
    names: list[str],
    separator: str,
    encoding: str,
    decode: Callable[[Column], Column],
) -> DataFrame:
    """The cells of every line and ``WIDTH``, from one scan of files that can be split.

    The lines come whole, without the headers, which the reader compares between files; each
    is parsed, judged by its quotes and measured against the whole header.
    """
    whole = {"sep": _NO_SEPARATOR, "quote": "", "escape": "", "encoding": encoding, "columnPruning": "false"}
    header = spark.read.options(**whole).csv(path).first()[0]
    fields = [StructField(header, StringType()), StructField(_MALFORMED, StringType())]
    raw = (
        spark.read.options(**whole, columnNameOfCorruptRecord=_MALFORMED)
        .option("header", True)
        .option("enforceSchema", False)
        .schema(StructType(fields))
        .csv(path)
    )
    line = decode(F.coalesce(F.col(_MALFORMED), _named(header)))
    cells = ", ".join(f"c{i} string" for i in range(len(names)))
    parser = {"escape": '"', "sep": separator, "columnNameOfCorruptRecord": _MALFORMED}
    parsed = raw.select(line.alias("line")).select(
        "line", F.from_csv("line", f"{cells}, {_MALFORMED} string", parser).alias("cells")
    )
    width = _line_width(F.col(f"cells.{_MALFORMED}"), len(names), separator)
    return parsed.select(
        *[F.col(f"cells.c{i}").alias(n) for i, n in enumerate(names)],
        F.when(_ends_in_quotes(F.col("line"), separator), F.lit(OPEN)).otherwise(width).alias(WIDTH),
    )


def _read_records(
    spark: SparkSession,
    path: str | list[str],
    header: list[str | None],
    names: list[str],
    separator: str,
    encoding: str,
    decode: Callable[[Column], Column],
) -> DataFrame:
    """The cells of every record and ``WIDTH``, where quoted fields may hold line breaks."""
    options = {"escape": '"', "sep": separator, "encoding": encoding, "multiLine": "true"}
    if names != header:
        _check_headers(spark, path, options)
    rows = (
        spark.read.options(**options)
        .option("header", True)
        # Compare the header of every file with the first one; made-up names are compared above.
        .option("enforceSchema", names != header)
        .option("columnNameOfCorruptRecord", _MALFORMED)
        # Rows are measured against the whole header, also when few columns are kept.
        .option("columnPruning", False)
        .schema(StructType([StructField(n, StringType()) for n in [*names, _MALFORMED]]))
        .csv(path)
    )
    return rows.select(
        *[decode(_named(n)).alias(n) for n in names],
        _line_width(F.col(_MALFORMED), len(names), separator).alias(WIDTH),
    )


def read_feed(
    spark: SparkSession,
    path: str | list[str],
    expected: Sequence[str],
    new_names: Sequence[str] | None = None,
    na_tokens: tuple[str, ...] = NA_TOKENS,
    multi_line: bool = False,
    separator: str = ",",
    encoding: str = "UTF-8",
) -> Feed:
    """Read delimited files, or files whose rows were wrapped into a single field.

    Every value is text; the tokens become NULL; header names are stripped; the result
    has just the expected columns. Files are split between tasks unless ``multi_line``
    is set, which lets a quoted field contain line breaks; without it such a field is an
    error. A quote within a field that does not begin with one is text. All files must have
    the same header line.

    ``encoding`` is any character set of one byte per character that Python knows, such as
    windows-1252, or one of UTF-8, UTF-16 and UTF-32, the latter two with ``multi_line``. For
    others set ``spark.sql.legacy.javaCharsets``.
    """
    charset, decode, decode_text = _decoding(spark, encoding)
    options = {"escape": '"', "sep": separator, "encoding": charset, "multiLine": str(multi_line).lower()}
    header_row = spark.read.options(**options).csv(path).first()
    if header_row is None:
        raise FeedError(f"no header in {path}")
    header = list(header_row)
    names = _unique_names(header)
    if multi_line:
        rows = _read_records(spark, path, header, names, separator, charset, decode)
    else:
        rows = _read_lines(spark, path, names, separator, charset, decode)
    cells = [na_to_null(_named(n), na_tokens).alias(decode_text(n)) for n in names]
    return shape_feed(rows.select(*cells, WIDTH), expected, new_names)
