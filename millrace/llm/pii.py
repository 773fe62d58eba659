"""Personal data in texts, by DataFrame functions alone.

Patterns propose spans; Luhn, mod-97 and digit counts confirm them; words nearby move the
score. ``email``, ``ip``, ``card`` and ``phone`` are kept whatever their score is. The other
kinds are ``iban`` (mod-97 and at least the score of ``MIN_SCORE``) and ``ssn`` (three, two
and four digits, which only words nearby lift over ``MIN_SCORE``).

Defined results: a null text counts as empty and has no spans; spans of one kind do not
overlap, spans of different kinds may; offsets count code points, end exclusive; rows are
independent, so repeated rows repeat their result; other columns are kept.
"""

from __future__ import annotations


from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.names import fresh, named

# Possessive quantifiers keep the search linear and never change a match: what follows each
# of them cannot begin with a character that it takes. A match begins where a run of its
# first characters does, or where the last match ended within one.
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # Runs of fewer digits cannot pass; a run of more is taken whole, from its first digit.
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: Without such a string a text cannot hold the kind, which spares the search.
_NEEDS = {"email": "@", "phone": "+", "ip": ".", "ssn": "-"}
BASE_KINDS = ("email", "ip", "card", "phone")

#: Score of a confirmed span before its surroundings are read.
BASE_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.8, "ssn": 0.4}
CONTEXT_BONUS = 0.35
CONTEXT_CHARS = 40
MIN_SCORE = 0.7
CONTEXT_WORDS = {
    "email": "mail|contact|write",
    "ip": "ip|host|server|address",
    "card": "card|visa|credit|payment",
    "phone": "phone|call|tel|mobile|fax",
    "iban": "iban|account|bank|konto",
    "ssn": "ssn|social|security",
}




#: Matches that are placed together. A running array is copied at every step, so that running
#: through all of n matches at once would take n * n steps.
_BLOCK = 1024
#: Code points of the pieces in which surroundings are looked up: to find a place in a string
#: takes as many steps as there are characters before it.
_PIECE = 4096
_NONE = "array<struct<start:int,value:string>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(steps: Column, size: Callable[[Column], Column], kept: Callable[[Column, Column], Column], kind: str) -> Column:
    """``at``, the sum of the sizes, and ``found``: each step beside the sum before it."""
    return F.aggregate(
        steps,
        F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("found")),
        lambda acc, x: F.struct(
            (acc["at"] + size(x)).alias("at"),
            F.concat(acc["found"], F.array(kept(acc["at"], x))).alias("found"),
        ),
    )


def _find(text: Column, kind: str) -> Column:
    """Structs ``start, value`` of all matches: starts are summed from the gaps between them.

    Matches are placed within blocks, then the blocks one after the other.
    """
    pattern = PATTERNS[kind]

    def place(both: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(both) - 1) / _BLOCK).cast("int")),
            lambda b: _running(
                F.slice(both, b * _BLOCK + 1, F.lit(_BLOCK)),
                lambda x: F.length(x["gap"]) + F.length(x["value"]),
                lambda at, x: F.struct((at + F.length(x["gap"])).alias("start"), x["value"].alias("value")),
                _NONE,
            ),
        )
        placed = _running(
            blocks,
            lambda b: b["at"],
            lambda at, b: F.struct(at.alias("at"), b["found"].alias("found")),
            f"array<struct<at:int,found:{_NONE}>>",
        )["found"]
        return F.flatten(
            F.transform(
                placed,
                lambda b: F.transform(
                    b["found"],
                    lambda m: F.struct((b["at"] + m["start"]).alias("start"), m["value"].alias("value")),
                ),
            )
        )

    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    both = _let(
        F.struct(matches.alias("m"), gaps.alias("g")),
        lambda x: F.arrays_zip(x["m"].alias("value"), F.slice(x["g"], F.lit(1), F.size(x["m"])).alias("gap")),
    )
    needed = F.contains(text, F.lit(_NEEDS[kind])) if kind in _NEEDS else F.lit(True)
    return F.when(needed & text.rlike(pattern), _let(both, place)).otherwise(F.array().cast(_NONE))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the sum of digits, every second from the right doubled, divides by ten."""
    doubled = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int"))
        .when(d.cast("int") > 4, d.cast("int") * 2 - 9)
        .otherwise(d.cast("int") * 2),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, b: a + b) % 10 == 0


def _mod97(value: Column) -> Column:
    """The check of an account number: its first four characters go last, letters count from 10."""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    moved = F.concat(F.substring(plain, 5, 1000), F.substring(plain, 1, 4))
    rest = F.aggregate(
        F.split(moved, ""),
        F.lit(0),
        lambda acc, ch: F.when(ch.between("0", "9"), (acc * 10 + ch.try_cast("int")) % 97).otherwise(
            (acc * 100 + F.ascii(ch) - 55) % 97
        ),
    )
    return rest == 1


def _confirmed(kind: str, value: Column) -> Column:
    if kind == "ip":
        parts = F.split(value, r"\.")
        return F.forall(
            parts,
            lambda p: F.length(F.ltrim(p, F.lit("0"))) <= F.lit(3),
        ) & F.forall(parts, lambda p: F.right(p, F.lit(3)).cast("int") <= 255)
    if kind == "card":
        digits = _digits(value)
        return F.length(digits).between(13, 19) & _luhn(digits)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    if kind == "iban":
        return _mod97(value)
    return F.lit(True)


def _scored(pieces: Column, kind: str, found: Column) -> Column:
    def span(m: Column, parts: Column) -> Column:
        end = m["start"] + F.length(m["value"])
        around = F.concat(
            _cut(parts, F.greatest(m["start"] - CONTEXT_CHARS, F.lit(0)), m["start"]),
            F.lit(" "),
            _cut(parts, end, end + CONTEXT_CHARS),
        )
        near = F.lower(around).rlike(rf"(?<![a-z])(?:{CONTEXT_WORDS[kind]})")
        score = F.lit(BASE_SCORE[kind]) + F.when(near, CONTEXT_BONUS).otherwise(0.0)
        return F.struct(
            F.lit(kind).alias("kind"),
            m["start"].cast("long").alias("start"),
            end.cast("long").alias("end"),
            F.least(score, F.lit(1.0)).alias("score"),
        )

    confirmed = F.filter(found, lambda m: _confirmed(kind, m["value"]))
    spans = F.flatten(
        F.transform(
            F.array(F.struct(pieces.alias("parts"), confirmed.alias("found"))),
            lambda x: F.transform(x["found"], lambda m: span(m, x["parts"])),
        )
    )
    return spans if kind in BASE_KINDS else F.filter(spans, lambda s: s["score"] >= MIN_SCORE)


def _cut(parts: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end``, fewer than a piece has, of a text given in pieces."""
    number = F.floor(start / _PIECE).cast("int")
    near = F.concat(
        F.coalesce(F.get(parts, number), F.lit("")), F.coalesce(F.get(parts, number + 1), F.lit(""))
    )
    return near.substr(start - number * _PIECE + 1, end - start)


def find_pii(df: DataFrame, text: str = "text", into: str = "pii") -> DataFrame:
    """Add ``into``: an array of ``kind, start, end, score``, by kind, then by start."""
    content = F.coalesce(named(text), F.lit(""))
    columns = dict(zip(PATTERNS, fresh(df.columns, *[f"_{into}_{k}" for k in PATTERNS])))
    (pieces,) = fresh([*df.columns, *columns.values()], f"_{into}_pieces")
    found = df.withColumns({column: _find(content, k) for k, column in columns.items()})
    # Most texts have no match, and need no pieces.
    some = F.greatest(*[F.size(F.col(column)) for column in columns.values()]) > 0
    cut = F.regexp_extract_all(content, F.lit(f"(?s).{{1,{_PIECE}}}"), F.lit(0))
    found = found.withColumn(pieces, F.when(some, cut))
    spans = [_scored(F.col(pieces), k, F.col(column)) for k, column in columns.items()]
    return found.withColumn(into, F.concat(*spans)).drop(pieces, *columns.values())


def _is(kind: str) -> Callable[[Column], Column]:
    return lambda found: found == kind


def pii_digest(df: DataFrame, pii: str = "pii") -> DataFrame:
    """The counts, the digest of the base spans and all spans as text."""

    def written(spans: Column) -> Column:
        return F.array_join(
            F.transform(
                spans,
                lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
            ),
            ",",
        )

    base = F.filter(F.col(pii), lambda s: s["kind"].isin(*BASE_KINDS))
    return df.select(
        "doc_id",
        *[
            F.size(F.filter(F.col(f"{pii}.kind"), _is(k))).cast("long").alias(f"n_{k}")
            for k in BASE_KINDS
        ],
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col(pii)).alias("spans"),
    )
