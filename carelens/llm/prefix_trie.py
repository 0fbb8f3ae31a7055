"""The trie of conversation prefixes by a van Emde Boas recursion over its depth.

The depths are cut at half: of every conversation the upper half is a path of the upper trie, and what follows is a path of
the lower trie that hangs from where the upper half ends.  Conversations with the same upper half share that lower trie, so
the upper half is named by a fingerprint of its turns, and name and lower half go on as a problem of half the depth.
Upper and lower problems of one depth are worked together, so the recursion takes as many steps as the depth has bits; at
its end each prefix has the name of the trie of depth one that stands on it.

Totals go up the same way: what the lower tries hold is summed at the nodes they hang from, and grafted on all ancestors of
those in the upper trie, half by half.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelens.llm.common import partitions, stored

#: Depths of a conversation that stay together in a task; longer stretches meet by joins.
SPAN = 4096
#: Children of one node that are joined with it in one task.
CHILDREN = 100_000
#: Up to so many nodes with more children are broadcast.
BROADCAST_NODES = 100_000
#: Ids of one piece of a list that is hashed.
PIECE = 20_000
NO_ENDS = hashlib.sha256(b"").hexdigest()


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, d, s, bytes): the turns of each conversation by their places from 1, with a digest of role and text.

    A conversation may be as long as it likes: turns are sorted over all tasks, and each is placed by the number of its
    conversation's turns in the tasks before and its place in its own.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), digest.alias("s"), F.octet_length(text).alias("bytes")
    )
    keys = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("s")]
    n_parts = partitions(conversations.sparkSession)
    placed = turns.repartitionByRange(n_parts, *keys).sortWithinPartitions(*keys)
    # The number holds the task above its 33 lowest bits, and rises in the order of the rows.
    placed = stored(placed.select("conv_id", "s", "bytes", F.monotonically_increasing_id().alias("at")).withColumn("task", F.shiftright("at", 33)), "turns")
    runs = placed.groupBy("conv_id", "task").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # a row per task at most
    runs = runs.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    return placed.join(runs, ["conv_id", "task"]).select("conv_id", (F.col("before") + F.col("at") - F.col("first") + 1).alias("d"), "s", "bytes")


def shared_turns(conv_id: Column, most: int = 9) -> Column:
    """How many turns a conversation takes from the first one of its five."""
    return F.crc32(conv_id.cast("string").cast("binary")) % most


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt turns (conv_id, d, s, bytes) and the lengths of all rebuilt conversations (conv_id, n).

    Conversation c starts with the first h turns of conversation c - c % 5 and goes on with its own behind its first h.
    """
    own = stored(ordered_turns(conversations), "own")
    base, h = F.expr("conv_id - conv_id % 5"), shared_turns(F.col("conv_id"))
    lengths = stored(own.groupBy("conv_id").agg(F.max("d").alias("n")), "lengths")
    known = lengths.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    plan = lengths.select("conv_id", "n", base.alias("base"), h.alias("h")).join(known, "base", "left")
    plan = plan.withColumn("head", F.least("h", F.coalesce("base_n", F.lit(0)))).withColumn("tail", F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    plan = stored(plan.select("conv_id", "base", "n", "h", "head", "tail"), "plan")

    starts = own.where("d <= 8 and conv_id % 5 = 0").withColumnRenamed("conv_id", "base")
    heads = plan.select("conv_id", "base", "head").join(starts, "base").where("d <= head").select("conv_id", "d", "s", "bytes")
    stretch = lambda d: F.expr(f"({d}) div {SPAN}")
    moved = plan.select("conv_id", "h", "head", F.explode(F.expr(f"sequence(0L, n div {SPAN})")).alias("q"))
    tails = own.withColumn("q", stretch("d")).join(moved, ["conv_id", "q"]).where("d > h")
    tails = tails.select("conv_id", (F.col("d") - F.col("h") + F.col("head")).alias("d"), "s", "bytes")
    return heads.unionByName(tails), plan.select("conv_id", (F.col("head") + F.col("tail")).alias("n"))


def _named(root: str, level: int, sums: list[str]) -> Column:
    """The name of the trie below a cut: that of the trie above, the depth of the cut, and the turns between them."""
    return F.md5(F.concat_ws(":", F.col(root), F.lit(level), *(F.col(c).cast("string") for c in sums)).cast("binary"))


_SUMS = ("f0", "f1", "f2", "f3")


def prefix_names(turns: DataFrame, lengths: DataFrame, depth: int) -> DataFrame:
    """(conv_id, p, node): a name for each prefix of p turns, from 0 to the whole conversation; equal prefixes share it.

    A prefix is found at the place behind it.  Its name comes from the cuts above that place: at each of them the upper
    half is known by four sums of 32-bit hashes of its turns at their places, 128 bits in all.
    """
    last = lengths.select("conv_id", F.col("n").alias("p"), F.lit(None).cast("string").alias("s"))
    rows = turns.select("conv_id", (F.col("d") - 1).alias("p"), "s").unionByName(last)
    rows = rows.withColumn("root", F.lit(""))
    for level in range(max(0, depth.bit_length() - 1), -1, -1):
        half = 1 << level
        place = F.expr(f"p % {2 * half}")
        lower = place >= half
        hashes = [F.xxhash64("s", place, F.lit(2 * level + k)) for k in (0, 1)]
        parts = [x for h in hashes for x in (h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32))]
        parts = [F.when(~lower & F.col("s").isNotNull(), x) for x in parts]
        block = F.expr(f"p div {2 * half}")
        if 2 * half <= SPAN:
            # All blocks of a stretch are in one task, so the levels below this one move no rows.
            around = Window.partitionBy("conv_id", "q", block)
            if "q" not in rows.columns:
                rows = rows.withColumn("q", F.expr(f"p div {SPAN}")).repartition(partitions(rows.sparkSession), "conv_id", "q")
            rows = rows.withColumns({f: F.sum(x).over(around) for f, x in zip(_SUMS, parts, strict=True)})
        else:
            rows = stored(rows.select("conv_id", "p", "s", "root"), "names")
            upper = rows.groupBy("conv_id", block.alias("block")).agg(*(F.sum(x).alias(f) for f, x in zip(_SUMS, parts, strict=True)))
            upper = upper.withColumn("stretch", F.explode(F.expr(f"sequence(0L, {(2 * half - 1) // SPAN}L)")))
            rows = rows.withColumn("block", block).withColumn("stretch", F.expr(f"(p % {2 * half}) div {SPAN}"))
            rows = rows.join(upper, ["conv_id", "block", "stretch"]).drop("block", "stretch")
        rows = rows.withColumn("root", F.when(lower, _named("root", level, list(_SUMS))).otherwise(F.col("root"))).drop(*_SUMS)
    return rows.select("conv_id", "p", F.col("root").alias("node"))


def _prefixes(turns: DataFrame, names: DataFrame) -> DataFrame:
    """(conv_id, p, node, parent, bytes) of every prefix of every conversation; bytes are those of its last turn."""
    none = lambda kind: F.lit(None).cast(kind)
    rows = names.select("conv_id", "p", "node", none("string").alias("parent"), none("bigint").alias("bytes"))
    rows = rows.unionByName(names.select("conv_id", (F.col("p") + 1).alias("p"), none("string").alias("node"), F.col("node").alias("parent"), none("bigint").alias("bytes")))
    rows = rows.unionByName(turns.select("conv_id", F.col("d").alias("p"), none("string").alias("node"), none("string").alias("parent"), F.col("bytes").cast("bigint").alias("bytes")))
    whole = rows.groupBy("conv_id", "p").agg(*(F.max(c).alias(c) for c in ("node", "parent", "bytes")))
    return whole.where("node is not null")  # one place too far was named as the parent's child


def _grafted(nodes: DataFrame, prefixes: DataFrame, depth: int) -> DataFrame:
    """(node, n_leaves, saved): the sums over each node's subtree of its own ``leaf`` and ``saved``."""
    totals = nodes.select("node", "depth", "conv_id", "parent", F.col("leaf").alias("n_leaves"), "saved")
    for level in range(depth.bit_length()):
        half = 1 << level
        # What hangs from the last nodes of the upper halves.
        hung = totals.where(f"depth % {2 * half} = {half}").groupBy("parent").agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        if half == 1:
            grafts = hung.withColumnRenamed("parent", "node")
        else:
            # Its ancestors in the upper half are prefixes of any conversation that holds it.
            cut = hung.join(nodes.select(F.col("node").alias("parent"), "conv_id", "depth"), "parent")
            cut = cut.withColumn("block", F.expr(f"depth div {2 * half}")).drop("depth", "parent")
            cut = cut.withColumn("stretch", F.explode(F.expr(f"sequence(0L, {(half - 1) // SPAN}L)")))
            paths = prefixes.where(f"p % {2 * half} < {half}").select("conv_id", "node", F.expr(f"p div {2 * half}").alias("block"), F.expr(f"(p % {2 * half}) div {SPAN}").alias("stretch"))
            met = paths.join(cut, ["conv_id", "block", "stretch"])
            grafts = met.groupBy("node").agg(F.sum("more_leaves").alias("more_leaves"), F.sum("more_saved").alias("more_saved"))
        totals = totals.join(grafts, "node", "left").select(
            "node", "depth", "conv_id", "parent",
            (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"), (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
        )
        totals = stored(totals, "totals")
    return totals.select("node", "n_leaves", "saved")


def _pieces_of_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ids of one node as one text; rows (node, conv_id) come sorted."""
    node, ids = None, []
    for batch in batches:
        out = []
        for name, conv_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if name != node or len(ids) >= PIECE:
                if ids:
                    out.append((node, ids[0], ",".join(map(str, ids))))
                node, ids = name, []
            ids.append(conv_id)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["node", "first", "ids"])
    if ids:
        yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([ids[0]]), pa.array([",".join(map(str, ids))])], names=["node", "first", "ids"])


def _hashed_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces, joined by commas; they come sorted and are taken up one by one."""
    node, digest = None, None
    for batch in batches:
        out = []
        for name, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if name != node or digest is None:
                if digest is not None:
                    out.append((node, digest.hexdigest()))
                node, digest = name, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["node", "ends_sha256"])
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([digest.hexdigest()])], names=["node", "ends_sha256"])


def _ends(prefixes: DataFrame, lengths: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the nodes where conversations end.

    A SHA-256 has to see its bytes in order, so the ids of one node pass through one task; they get there as texts of many
    ids, made by as many tasks as the ids take, and are not held together.
    """
    n_parts = partitions(prefixes.sparkSession)
    ends = prefixes.join(lengths.select("conv_id", F.col("n").alias("p")), ["conv_id", "p"]).select("node", "conv_id")
    runs = ends.repartitionByRange(n_parts, "node", "conv_id").sortWithinPartitions("node", "conv_id")
    pieces = runs.mapInArrow(_pieces_of_ids, "node string, first bigint, ids string")
    ordered = pieces.repartition(n_parts, "node").sortWithinPartitions("node", "first")
    return ordered.mapInArrow(_hashed_pieces, "node string, ends_sha256 string")


def _with_parents(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``parent_conv_id``.  Children of a node that has very many are dealt over several tasks."""
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), (F.expr(f"n_children div {CHILDREN}") + 1).alias("deals"))
    wide = parents.where("deals > 1").select("parent", "deals")
    if wide.count() <= BROADCAST_NODES:  # one for each CHILDREN nodes at most
        wide = F.broadcast(wide)
    children = nodes.join(wide, "parent", "left").withColumn("deal", F.pmod(F.xxhash64("node"), F.coalesce("deals", F.lit(1).cast("bigint")))).drop("deals")
    copies = parents.withColumn("deal", F.explode(F.expr("sequence(0L, deals - 1)"))).drop("deals")
    return children.join(copies, ["parent", "deal"], "left").drop("deal")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """Per node of the trie of rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256, and ``node``, its name.

    ``conversations`` has conv_id, turn, role, text.  NULL roles and texts are empty; NULL turns come first; turns of equal
    number follow the digest of role and text, and repeated rows are turns of their own.  Rows without a conv_id are left
    out, other columns are ignored, and an empty table gives no rows.
    """
    turns, lengths = rebuilt(conversations)
    turns, lengths = stored(turns, "rebuilt"), stored(lengths, "ends")
    depth = lengths.agg(F.max("n")).first()[0] or 0
    prefixes = stored(_prefixes(turns, prefix_names(turns, lengths, depth)), "prefixes")
    nodes = prefixes.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.min("p").alias("depth"), F.min("parent").alias("parent"), F.min("bytes").alias("bytes"), F.count("*").alias("n_convs")
    )
    nodes = stored(nodes, "nodes")
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("bigint")))
    saved = (F.col("n_convs") - 1) * F.coalesce("bytes", F.lit(0).cast("bigint"))
    nodes = stored(nodes.withColumns({"leaf": (F.col("n_children") == 0).cast("bigint"), "saved": saved}), "family")

    totals = _grafted(nodes, prefixes, depth)
    out = _with_parents(nodes.drop("leaf", "saved", "bytes")).join(totals, "node").join(_ends(prefixes, lengths), "node", "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"), "node",
    )


def _crc32_sql(text: str) -> str:
    """CRC-32 of a text of ASCII characters in DuckDB: of each byte its exclusive or, then eight shifts."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}), lambda a, x: {step}), 4294967295::BIGINT)"


#: The same rows in DuckDB: prefixes are lists, and a conversation carries its sums from its end to each prefix.
TRIE_SQL = f"""
WITH own AS (
    SELECT conv_id, sha256(octet_length(encode(role))::VARCHAR || ':' || role || text) AS s, octet_length(encode(text)) AS bytes,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
            sha256(octet_length(encode(role))::VARCHAR || ':' || role || text)) AS d
    FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
), convs AS (
    SELECT conv_id, conv_id - conv_id % 5 AS base, {_crc32_sql("conv_id::VARCHAR")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM own)
), turns AS (
    SELECT c.conv_id, 0 AS part, o.d, o.s, o.bytes FROM convs c JOIN own o ON o.conv_id = c.base AND o.d <= c.h
    UNION ALL
    SELECT c.conv_id, 1, o.d, o.s, o.bytes FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.d > c.h
), placed AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, d) AS d, s, bytes FROM turns
), prefixes AS (
    SELECT conv_id, 0::BIGINT AS d, []::VARCHAR[] AS node, 0::BIGINT AS bytes FROM convs
    UNION ALL
    SELECT conv_id, d, list(s) OVER (PARTITION BY conv_id ORDER BY d), bytes FROM placed
), nodes AS (
    SELECT node, min(conv_id) AS conv_id, min(d) AS depth, count(*) AS n_convs, (count(*) - 1) * min(bytes) AS saved FROM prefixes GROUP BY node
), family AS (
    SELECT n.*, p.conv_id AS parent_conv_id, coalesce(k.n_children, 0) AS n_children
    FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.node = n.node[1:n.depth - 1]
    LEFT JOIN (SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1) k ON k.node = n.node
), carried AS (
    SELECT x.node, sum(CASE WHEN f.n_children = 0 THEN 1 ELSE 0 END) OVER w AS leaves, sum(coalesce(f.saved, 0)) OVER w AS saved
    FROM prefixes x LEFT JOIN family f ON f.node = x.node AND f.conv_id = x.conv_id
    WINDOW w AS (PARTITION BY x.conv_id ORDER BY x.d DESC)
), totals AS (
    SELECT node, sum(leaves)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM carried GROUP BY node
), ends AS (
    SELECT node, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256
    FROM (SELECT conv_id, max_by(node, d) AS node FROM prefixes GROUP BY conv_id) GROUP BY node
)
SELECT f.conv_id, f.depth, f.parent_conv_id, f.n_convs, f.n_children, t.n_leaves, t.saved_tokens, coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM family f JOIN totals t ON t.node = f.node LEFT JOIN ends e ON e.node = f.node
"""
