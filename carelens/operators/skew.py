"""Keyed enrichment that stays parallel when one key holds a large share of a table.

Without heavy keys every side is LEFT JOINed on the one key, which costs one shuffle of the register.  When a table has
more rows than one task should get of a key, keys are counted first.  Keys with more rows than that are few by
arithmetic (at most one for so many rows of a table), whatever the data; their rows are taken out and joined over a grid
of cells: left rows are spread over the grid's rows, right rows over its columns, and each side is copied along the other
axis, so every pair meets in exactly one cell and no task holds a whole group.

Heavy keys and their counts are a table in the shared folder; the driver learns how many there are, not which.
"""

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.functions.keys import named, ref
from carelens.scratch import written

# A group below this many rows is no burden to one task; it is also the number of rows aimed at per cell.
HEAVY_ROWS = 200_000
# Up to so many heavy keys are broadcast; more of them are joined by a shuffle.
BROADCAST_KEYS = 100_000

_REPEAT_CHUNK = 1000


def repeat_rows(df: DataFrame, times: str, identity: list[str]) -> DataFrame:
    """Each row as many times as its count says, in two steps so that no array grows with the count.

    ``__row`` tells the copies apart, from the columns that identify a row and the number of the copy.
    """
    kept = [ref(c) for c in df.columns if c != times]
    chunked = df.selectExpr("*", f"explode(sequence(0L, ({times} - 1) div {_REPEAT_CHUNK})) AS __chunk")
    in_chunk = f"least({_REPEAT_CHUNK}L, {times} - __chunk * {_REPEAT_CHUNK})"
    copied = chunked.selectExpr("*", f"explode(sequence(1L, {in_chunk})) AS __copy")
    return copied.selectExpr(*kept, f"xxhash64({', '.join([*map(ref, identity), '__chunk', '__copy'])}) AS __row")


def heavy_keys(frames: Sequence[DataFrame], key: str, min_rows: int = HEAVY_ROWS) -> DataFrame:
    """(__key, n0, n1, …): the keys with more than ``min_rows`` rows in any frame, with their rows in each of them.

    One pass over the key columns: counts are added up before the only shuffle, so a heavy key is one row of each task.
    """
    tagged = [f.selectExpr(f"{i} AS frame", named(ref(key), "__key")) for i, f in enumerate(frames)]
    counts = [F.expr(f"count(CASE WHEN frame = {i} THEN 1 END) AS n{i}") for i in range(len(frames))]
    seen = reduce(DataFrame.union, tagged).groupBy("__key").agg(*counts)
    return seen.where(" OR ".join(f"n{i} > {min_rows}" for i in range(len(frames))))


def _has_burden(inputs: Iterable[DataFrame], skew_check: str, min_rows: int) -> bool:
    """Whether keys are to be counted: a table with ``min_rows`` rows in all has no key with more.

    Rows are counted, as bytes say nothing: columnar files store a key's repetitions in next to no space.
    """
    if skew_check != "auto":
        return skew_check == "always"
    tagged = [f.selectExpr(f"{i} AS frame") for i, f in enumerate(inputs)]
    rows = reduce(DataFrame.union, tagged).groupBy("frame").agg(F.expr("count(1) AS n"))
    return bool(tagged) and not rows.where(f"n > {min_rows}").isEmpty()


def _chain(fact: DataFrame, sides: Mapping[str, DataFrame], key: str) -> DataFrame:
    return reduce(lambda left, side: left.join(side.drop("__row"), key, "left"), sides.values(), fact.drop("__row"))


def with_row_id(df: DataFrame) -> DataFrame:
    """A row number that a rerun of the same scan gives again; equal rows get different ones.

    To be taken where rows come from a scan.  Frames behind a shuffle bring a ``__row`` of their own.
    """
    return df if "__row" in df.columns else df.withColumn("__row", F.monotonically_increasing_id())


def _grid_join(left: DataFrame, side: DataFrame, key: str, cells: DataFrame, repeats: bool) -> DataFrame:
    """LEFT JOIN for heavy keys.  ``cells`` gives per key the grid size (``rows`` × ``cols``).

    A left row visits every column, so its unmatched copies are dropped unless the key has a single column; more than
    one column means the side does hold the key.
    """
    grid = cells
    lefts = (
        left.join(grid, F.expr(f"{ref(key)} <=> __key"))
        .selectExpr(
            *map(ref, left.columns),
            "__cols = 1 AS __single",
            "pmod(xxhash64(__row), __rows) AS __a",
            "explode(sequence(0L, __cols - 1)) AS __b",
        )
    )
    taken = [ref(c) for c in side.columns if c != "__row"]
    rights = (
        side.join(grid, F.expr(f"{ref(key)} = __key"))
        .selectExpr(
            *taken,
            "__row AS __side_row",
            "pmod(xxhash64(__row), __cols) AS __b",
            "explode(sequence(0L, __rows - 1)) AS __a",
        )
    )
    kept = lefts.join(rights, [key, "__a", "__b"], "left").where("__side_row IS NOT NULL OR __single")
    if repeats:
        kept = kept.withColumn("__row", F.xxhash64("__row", "__side_row"))
    return kept.drop("__a", "__b", "__single", "__side_row")


def enrich_by_key(
    fact: DataFrame,
    sources: Mapping[str, DataFrame],
    aggregates: Mapping[str, DataFrame],
    key: str,
    measured: Iterable[DataFrame],
    skew_check: str = "auto",
    min_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """LEFT JOIN all sides on the key: ``sources`` may repeat it, ``aggregates`` hold it once.

    ``skew_check`` is ``auto`` (count keys first if a table of ``measured`` has more than ``min_rows`` rows), ``always`` or ``never``.
    """
    sides = {**aggregates, **sources}
    if not _has_burden([*measured], skew_check, min_rows):
        return _chain(fact, sides, key)
    heavy = written(heavy_keys([fact, *sources.values()], key, min_rows), "heavy-keys")
    n_heavy = heavy.count()  # from the footers of what was written
    if not n_heavy:
        return _chain(fact, sides, key)

    def sent(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if n_heavy <= BROADCAST_KEYS else df

    keys = sent(heavy.select("__key"))
    is_heavy = F.expr(f"{ref(key)} <=> __key")

    def light(df: DataFrame) -> DataFrame:
        return df.join(keys, is_heavy, "left_anti")

    def burdened(df: DataFrame) -> DataFrame:
        return with_row_id(df).join(keys, is_heavy, "left_semi")

    def fan(rows: str) -> str:
        return f"CAST(least(greatest(1, ceil(({rows}) / {float(min_rows)})), 1000000000) AS BIGINT)"

    # Rows on the left grow with every side that repeats the key; a NULL key has no match.
    left, left_rows = burdened(fact), "CAST(n0 AS DOUBLE)"
    place = {name: i + 1 for i, name in enumerate(sources)}
    for name, side in sides.items():
        own = f"CASE WHEN __key IS NULL THEN 0 ELSE n{place[name]} END" if name in place else "1"
        grid = sent(heavy.selectExpr("__key", f"{fan(left_rows)} AS __rows", f"{fan(own)} AS __cols"))
        left = _grid_join(left, burdened(side), key, grid, name in sources)
        if name in place:
            left_rows = f"{left_rows} * greatest(1, {own})"
    regular = _chain(light(fact), {name: light(side) for name, side in sides.items()}, key)
    return regular.unionByName(left.drop("__row"))
