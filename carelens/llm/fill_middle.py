"""Fill-in-the-middle: each text is cut into prefix, middle and suffix, which go behind sentinels in another order.

A batch is worked by columns with pyarrow.compute: texts are split into lists of units, the lists are flattened with the
indices of their parents, each unit gets its ordinal in its text, units are filtered by role, the lists are rebuilt, and
the pieces are joined with the sentinels.  Where a text is cut follows from its doc_id alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from carelens.llm.common import CHUNK_BYTES, slices

#: A unit: a run of letters A-Z or a-z, or one other code point (in UTF-8; the last part takes stray bytes).
UNIT = rb"[A-Za-z]+|[\x00-\x40\x5b-\x60\x7b-\x7f]|[\xc2-\xf4][\x80-\xbf]+|[\x80-\xff]"
#: A byte that no UTF-8 text holds.
_MARK = b"\xff"
SENTINELS = (b"<P>", b"<S>", b"<M>")
FIELDS = [
    StructField("n_units", LongType()), StructField("form", StringType()), StructField("prefix_chars", LongType()),
    StructField("middle_chars", LongType()), StructField("output", StringType()),
]
_DRAWS = ("__h1", "__h2", "__h3", "__h4")


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four numbers below 2**32 of a document: the first groups of 8 digits of the hex SHA-256 of ``seed:doc_id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]


def _modulo(a: pa.Array, b: pa.Array | int) -> pa.Array:
    return pc.subtract(a, pc.multiply(pc.divide(a, b), b))


def _bounded(batches: Iterator[pa.RecordBatch], place: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``CHUNK_BYTES`` of text; a longer text comes alone."""
    for batch in slices(batches):
        sizes = pc.fill_null(pc.binary_length(batch.column(place)), 0).to_numpy(zero_copy_only=False)
        block = np.cumsum(sizes) // CHUNK_BYTES
        first = 0
        for last in [*(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]:
            if last > first:
                yield batch.slice(first, last - first)
            first = last


def _joined(flat: pa.Array, role: pa.Array, counts: pa.Array) -> pa.Array:
    """The units of one role joined for each text; ``counts`` tells how many of them each text has."""
    offsets = pc.cast(pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(counts)]), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, flat.filter(role)), pa.scalar(b"", flat.type))


def cut_texts(texts: pa.Array, h: list[pa.Array], plain_percent: int, spm_percent: int) -> list[pa.Array]:
    """Units of each text, its form, code points of prefix and middle (NULL in plain ones), and what is written."""
    raw = pc.fill_null(texts, "").cast(pa.large_binary())
    marked = pc.replace_substring_regex(raw, pattern=UNIT, replacement=b"\\0" + _MARK)
    units = pc.split_pattern(marked, pattern=_MARK)  # behind the last mark comes an empty unit
    n = pc.cast(pc.subtract(pc.list_value_length(units), 1), pa.int64())
    flat, parent = pc.list_flatten(units), pc.list_parent_indices(units)
    starts = pc.subtract(pc.cumulative_sum(pc.add(n, 1)), pc.add(n, 1))
    ordinal = pc.subtract(pa.array(np.arange(len(flat))), pc.take(starts, parent))

    places = pc.add(n, 1)
    one, two = _modulo(h[0], places), _modulo(h[1], places)
    first, second = pc.min_element_wise(one, two), pc.max_element_wise(one, two)
    before = pc.less(ordinal, pc.take(first, parent))
    upto = pc.less(ordinal, pc.take(second, parent))
    prefix = _joined(flat, before, first)
    middle = _joined(flat, pc.and_not(upto, before), pc.subtract(second, first))
    suffix = _joined(flat, pc.invert(upto), pc.subtract(places, second))

    taken = [pc.match_substring(raw, pattern=s) for s in SENTINELS]
    plain = pc.or_(pc.or_(pc.equal(n, 0), pc.or_(taken[0], pc.or_(taken[1], taken[2]))), pc.greater_equal(_modulo(h[2], 100), plain_percent))
    spm = pc.less(_modulo(h[3], 100), spm_percent)
    p, s, m, none = (pa.scalar(x, pa.large_binary()) for x in (*SENTINELS, b""))
    by_suffix = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, none)
    by_prefix = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, none)
    written = pc.if_else(plain, raw, pc.if_else(spm, by_suffix, by_prefix))
    form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))
    length = lambda piece: pc.if_else(plain, pa.scalar(None, pa.int64()), pc.cast(pc.utf8_length(piece.cast(pa.large_string())), pa.int64()))
    return [n, form.cast(pa.string()), length(prefix), length(middle), written.cast(pa.string())]


def restore_texts(written: pa.Array, form: pa.Array) -> pa.Array:
    """The texts again, from what was written and its form.

    A text that holds a sentinel is plain, so the sentinels of the others part exactly their three pieces.
    """
    raw = written.cast(pa.large_binary())
    moved = pc.not_equal(form, "plain")
    parts = pc.split_pattern_regex(raw.filter(moved), pattern=b"<[PSM]>")
    if not len(parts):
        return written
    one, two, middle = (pc.list_element(parts, k) for k in (1, 2, 3))
    spm = pc.equal(form.filter(moved), "spm")
    prefix, suffix = pc.if_else(spm, two, one), pc.if_else(spm, one, two)
    whole = pc.binary_join_element_wise(prefix, middle, suffix, pa.scalar(b"", pa.large_binary()))
    return pc.replace_with_mask(raw, moved, whole).cast(pa.string())


def fill_in_middle(docs: DataFrame, seed: int = 1, plain_percent: int = 90, spm_percent: int = 20) -> DataFrame:
    """``docs`` with n_units, form (``plain``, ``psm``, ``spm``), prefix_chars, middle_chars and output.

    Two draws say before which units the middle starts and ends; a text without units, with a sentinel in it, or whose
    third draw is at ``plain_percent`` or above stays plain.  A NULL text is empty.  Rows that repeat a doc_id are cut at
    the same draws, rows without one share theirs; an empty table gives no rows.  Columns of ``docs`` that are called as
    one of the results are replaced by it.
    """
    docs = docs.drop(*(f.name for f in FIELDS), *_DRAWS)
    names, place = docs.columns, docs.columns.index("text")
    rows = docs.select(*(F.col(f"`{c}`") for c in names), *(h.alias(x) for h, x in zip(draws(F.col("doc_id"), seed), _DRAWS, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _bounded(batches, place):
            h = [batch.column(len(names) + k) for k in range(4)]
            found = cut_texts(batch.column(place), h, plain_percent, spm_percent)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *found], names=[*names, *(f.name for f in FIELDS)])

    return rows.mapInArrow(run, StructType([*docs.schema, *FIELDS]))


def restored(written: DataFrame) -> DataFrame:
    """``written`` (as ``fill_in_middle`` gives it) with ``text`` rebuilt from ``output`` and ``form`` alone."""
    rows = written.drop("text")
    names = rows.columns
    place, form = names.index("output"), names.index("form")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _bounded(batches, place):
            text = restore_texts(batch.column(place), batch.column(form))
            yield pa.RecordBatch.from_arrays([*batch.columns, text], names=[*names, "text"])

    return rows.mapInArrow(run, StructType([*rows.schema, StructField("text", StringType())]))


def middle_digest(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n, form, prefix_chars, middle_chars, and the SHA-256 of the output and of the text rebuilt from it."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = restored(fill_in_middle(rows))
    digest = lambda c, name: F.sha2(F.col(c), 256).alias(name)
    return out.select("doc_id", F.col("n_units").alias("n"), "form", "prefix_chars", "middle_chars", digest("output", "output_sha256"), digest("text", "restored_sha256"))


#: The same rows in DuckDB.
MIDDLE_SQL = """
WITH units AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
        sha256('1:' || doc_id::VARCHAR) AS h
    FROM documents
), drawn AS (
    SELECT doc_id, text, u, len(u)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
        ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
    FROM units
), cut AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
            THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
), pieces AS (
    SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS p, coalesce(array_to_string(u[a + 1:b], ''), '') AS m,
        coalesce(array_to_string(u[b + 1:], ''), '') AS s
    FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM pieces
"""
