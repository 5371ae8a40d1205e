"""Operator 12, fill-in-middle transformation by repeated-capture matching.

One fullmatch of ``(unit)*`` with the regex library keeps every repetition of its group:
``match.ends(1)`` has as many entries as the text has units, and the end offset of each, so the
number of units and both cuts are read off it without a loop over the text.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import fresh, pieces, prepare

UNIT = "."                       # one code point (line ends included)
SENTINELS = ("<P>", "<S>", "<M>")
PLAIN_FROM = 90                  # h3 % 100 from which a text stays plain
SPM_BELOW = 20                   # h4 % 100 below which the suffix goes first
START = "1:"                     # doc_id behind it is hashed to choose form and cuts
SEGMENT = 1 << 18                # units matched at once: a match keeps some 60 bytes a unit
PIECE_BYTES = 256 * 1024
_LOADED: dict = {}


def unit_ends(text: str, unit: str = UNIT) -> list:
    """End offsets of the units of ``text``, as lists by segment (one list, unless the text has
    more than SEGMENT units).  Raises where units do not cover the text."""
    if unit not in _LOADED:
        import regex
        _LOADED[unit] = (regex.compile(f"(?s)({unit})*"), regex.compile(f"(?s)({unit}){{0,{SEGMENT}}}+"))
    whole, some = _LOADED[unit]
    if len(text) <= SEGMENT:                       # a unit has at least one character
        found = whole.fullmatch(text)
        if found is None:
            raise ValueError(f"the unit {unit!r} does not cover every text")
        return [found.ends(1)]
    out, at = [], 0
    while at < len(text):
        found = some.match(text, at)
        if found is None or found.end() == at:
            raise ValueError(f"the unit {unit!r} does not cover every text")
        out.append(array_of(found.ends(1)))
        at = found.end()
    return out


def array_of(ends: list):
    """Offsets in eight bytes each."""
    from array import array
    return array("q", ends)


def _end(ends: list, n: int) -> int:
    """Offset behind the first ``n`` units."""
    if n == 0:
        return 0
    for part in ends:
        if n <= len(part):
            return part[n - 1]
        n -= len(part)
    raise IndexError(n)


def transform(text: str, h: tuple, unit: str = UNIT, sentinels=SENTINELS):
    """(units, form, prefix characters, middle characters, output) of one text."""
    ends = unit_ends(text, unit)
    n = sum(map(len, ends))
    h1, h2, h3, h4 = h
    p, s, m = sentinels
    if not text or h3 % 100 >= PLAIN_FROM or any(x in text for x in sentinels):
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    i, j = _end(ends, a), _end(ends, b)
    if h4 % 100 < SPM_BELOW:
        return n, "spm", i, j - i, f"{s}{text[j:]}{p}{text[:i]}{m}{text[i:j]}"
    return n, "psm", i, j - i, f"{p}{text[:i]}{s}{text[j:]}{m}{text[i:j]}"


def names(columns) -> list[str]:
    return [fresh(c, columns) for c in ("n", "form", "prefix_chars", "middle_chars", "output")]


def fill_in_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", unit: str = UNIT,
                   sentinels=SENTINELS, start: str = START) -> DataFrame:
    """``docs`` (all columns) with ``n, form, prefix_chars, middle_chars, output`` added, under
    names from :func:`names` that clash with no column.

    Form and cuts come from the SHA-256 of ``start`` and the row's id alone (a null id is the
    empty text), so reruns and repeated rows agree.  Null and empty texts, and texts that hold
    a sentinel, stay plain; an empty table gives an empty result.  Nothing is shuffled.
    """
    prepare(docs.sparkSession)
    added = names(docs.columns)
    digest = F.sha2(F.concat(F.lit(start), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))).cast("binary"), 256)
    extra = [fresh(c, docs.columns) for c in ("_text", "_h1", "_h2", "_h3", "_h4")]
    src = docs.select("*", F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(extra[0]),
                      *[F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(c) for i, c in enumerate(extra[1:])])
    width = len(docs.columns)

    def run(batches):
        for b in pieces(batches, extra[0], PIECE_BYTES):
            rows = [transform(t, h, unit, sentinels) for t, *h in zip(*[b.column(i).to_pylist() for i in range(width, width + 5)])]
            cols = zip(*rows)
            yield pa.RecordBatch.from_arrays([*b.columns[:width], *[pa.array(c, t) for c, t in zip(cols, kinds)]],
                                             names=[*b.schema.names[:width], *added])

    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    types = [LongType(), StringType(), LongType(), LongType(), StringType()]
    return src.mapInArrow(run, StructType([*docs.schema.fields, *[StructField(c, t) for c, t in zip(added, types)]]))


def restored(output, form, sentinels=SENTINELS) -> F.Column:
    """The exact text behind columns ``output`` and ``form``: a text with cuts holds no sentinel
    of its own, so the three sentinels of its output part it."""
    out, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    part = F.split(out, "|".join("\\Q" + s + "\\E" for s in sentinels), -1)
    # behind the first sentinel: prefix, suffix, middle or suffix, prefix, middle
    return (F.when(form == "plain", out)
            .when(form == "psm", F.concat(part[1], part[3], part[2]))
            .otherwise(F.concat(part[2], part[3], part[1])))


def middle_report(docs: DataFrame) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256``."""
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return (fill_in_middle(docs.select("doc_id", "text"))
            .select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"),
                    sha(restored("output", "form")).alias("restored_sha256")))
