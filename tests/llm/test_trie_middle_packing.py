"""Prefix trie, fill-in-the-middle and packing against brute force and round trips, and against SQL."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import public_tokenizers
from carelens.llm import fill_middle, packing, prefix_trie
from carelens.llm import queries as registered
from tests.compare import compare, duck
from tests.llm.docs import documents, frame

SF_DIR = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_sql(spark, name):
    assert compare(registered.queries()[name](spark, SF_DIR), duck(SF_DIR), registered.oracle_sql()[name]) == []


# --- fill in the middle


def middle_row(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    h = [int(sha(f"1:{'' if doc_id is None else doc_id}")[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (doc_id, n, "plain", None, None, sha(text), sha(text))
    form = "spm" if h[3] % 100 < 20 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return (doc_id, n, form, len(p), len(m), sha(out), sha(text))


def test_middle_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(fill_middle, "CHUNK_BYTES", 5000)
    extra = ["a<P>b", "<", "<P", "x<S> y <M>", "P><S", "\n\r\t \u0000 z", "é漢😀" * 50, "<<P<S<M" * 9]
    rows = [*documents(), *((9000 + i, t, None, None, 0) for i, t in enumerate(extra))]
    got = fill_middle.middle_digest(frame(spark, rows)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr(middle_row(r[0], r[1])) for r in rows)


def test_middle_keeps_columns(spark):
    docs = frame(spark).withColumn("form", F.lit("clash")).withColumn("output", F.lit(1)).withColumn("__h1", F.lit(2))
    out = fill_middle.fill_in_middle(docs)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_units", "form", "prefix_chars", "middle_chars", "output"]
    back = fill_middle.restored(out.withColumn("was", F.coalesce("text", F.lit(""))))
    assert back.where("text <> was").count() == 0 and back.count() == len(documents())
    assert fill_middle.middle_digest(docs.limit(0)).count() == 0
    plain = fill_middle.fill_in_middle(docs, plain_percent=0)
    assert {r["form"] for r in plain.collect()} == {"plain"}


# --- prefix trie


def trie(rows):
    """Nodes by walking every rebuilt conversation."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            s = sha(f"{len(role.encode())}:{role}{text}")
            own[c].append(((turn is not None, turn or 0), s, len(text.encode())))
    own = {c: [x[1:] for x in sorted(own[c])] for c in own}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(whole):
        for d in range(len(whole[c]) + 1):
            members[tuple(whole[c][:d])].append(c)
        ends[tuple(whole[c])].append(c)
    children, saved, leaves = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, held in members.items():
        own_saved = (len(held) - 1) * node[-1][1] if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += own_saved
            leaves[node[:d]] += not children[node]
    return sorted(
        (m[0], len(n), members[n[:-1]][0] if n else -1, len(m), children[n], leaves[n], saved[n], sha(",".join(map(str, ends[n]))))
        for n, m in members.items()
    )


def conversations(long=40):
    rng = random.Random(8)
    rows = []
    for c in range(0, 120):
        if c % 5 == 0 and rng.random() < 0.3:
            continue  # a group without its first conversation
        first = rng.choice(["hi", "hello", "hi"])
        n = rng.choice([1, 2, 3, 4, 7, 9, 12]) if c != 33 else long
        rows += [(c, t, rng.choice(["user", "bot"]) if t else "user", first if t == 0 else rng.choice(["yes", "no", "é" * t])) for t in range(n)]
    rows += [(33, 5, "user", "same turn"), (33, 5, "user", "same turn"), (35, None, None, None), (35, None, "x", None), (None, 1, "a", "b"), (1001, 0, "user", "alone")]
    rows += [(1002, t, "user", "w" * 3000) for t in range(3)] + [(-7, 1, "user", "below zero")]
    return rows


def got_trie(frame):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(-1 if v is None else v for v in r) for r in frame.select(columns).collect())


@pytest.mark.parametrize("span", [4, 4096])
def test_trie_by_brute_force(spark, monkeypatch, span):
    monkeypatch.setattr(prefix_trie, "SPAN", span)
    monkeypatch.setattr(prefix_trie, "CHILDREN", 3)
    monkeypatch.setattr(prefix_trie, "PIECE", 4)
    rows = [r for r in conversations() if r[0] != -7]
    schema = "conv_id bigint, turn bigint, role string, text string"
    talks = spark.createDataFrame(rows, schema).repartition(7).withColumn("depth", F.lit("clash")).withColumn("node", F.lit(0))
    assert got_trie(prefix_trie.prefix_trie(talks)) == trie(rows)


def test_trie_of_hard_tables(spark):
    schema = "conv_id bigint, turn bigint, role string, text string"
    assert prefix_trie.prefix_trie(spark.createDataFrame([], schema)).count() == 0
    assert prefix_trie.prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], schema)).count() == 0
    same = [(c, t, "user", "copy") for c in range(0, 50, 5) for t in range(3)]
    assert got_trie(prefix_trie.prefix_trie(spark.createDataFrame(same, schema))) == trie(same)
    # Negative numbers have a base towards zero, as the remainder has their sign.
    assert prefix_trie.prefix_trie(spark.createDataFrame([(-7, 1, "user", "below zero")], schema)).count() >= 1


# --- packing


def pack(spark, sizes, capacity=1024):
    items = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "row bigint, size int")
    return [tuple(r) for r in packing.pack_sizes(items, capacity).collect()]


def bins_of(sizes, packed, capacity=1024):
    """Every row once, each sequence gapless from 0 and within its capacity; returns how many there are."""
    assert sorted(r for r, _, _ in packed) == list(range(len(sizes)))
    held = defaultdict(list)
    for row, sequence, offset in packed:
        held[sequence].append((offset, sizes[row]))
    for parts in held.values():
        upto = 0
        for offset, size in sorted(parts):
            assert offset == upto
            upto += size
        assert upto <= capacity
    return len(held)


def best_fit_decreasing(sizes, capacity=1024):
    work = packing.Packings(np.sort(np.array(sizes))[::-1].astype(np.int64), capacity, np.random.default_rng(1))
    return work.worth(work.first())[0]


def test_packing_needs_few_bins(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 300)
    rng = random.Random(2)
    mixed = [min(1023, max(1, int(rng.lognormvariate(5, 1)))) for _ in range(3000)]
    assert bins_of(mixed, pack(spark, mixed)) <= -(-sum(mixed) // 1024) + 2
    triples = [x for _ in range(200) for x in (lambda a, b: (a, b, 1024 - a - b))(rng.randint(260, 400), rng.randint(260, 360))]
    assert bins_of(triples, pack(spark, triples)) <= 0.98 * best_fit_decreasing(triples)  # the least possible: 200
    large = [600] * 500
    assert bins_of(large, pack(spark, large)) == 500
    assert pack(spark, []) == [] and bins_of([5], pack(spark, [5])) == 1


def test_children_keep_every_document():
    rng = np.random.default_rng(4)
    sizes = np.sort(rng.integers(150, 520, 800))[::-1].astype(np.int64)
    work = packing.Packings(sizes, 1024, rng)
    population = [work.first(), *(work.varied() for _ in range(4))]
    start = min(work.worth(g) for g in population)
    for _ in range(30):
        child = work.child(population[0], population[int(rng.integers(1, 5))])
        fills = work.fills(child)
        assert len(child) == len(sizes) and fills.max() <= 1024 and fills.min() > 0
    assert work.worth(work.evolve(population, 60)[0]) <= start


def test_pieces_of_documents(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = frame(spark).withColumn("row", F.lit("clash")).withColumn("size", F.lit(0))
    got = packing.packed_pieces(docs, path).toPandas()
    library = Tokenizer.from_file(path)
    want = []
    for doc_id, text, *_ in documents():
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        head = (len(ids) - 1) % 1024 + 1
        for piece, (a, b) in enumerate(zip([0, *range(head, len(ids), 1024)], [*range(head, len(ids) + 1, 1024)], strict=True)):
            want.append((doc_id, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(repr, want)) == sorted(repr((None if r[0] != r[0] else int(r[0]), *map(int, r[1:]))) for r in got[columns].itertuples(index=False))
    for _, held in got.sort_values("offset").groupby("sequence_id"):
        assert (held["offset"] == held["length"].cumsum() - held["length"]).all() and held["length"].sum() <= 1024
    assert got["sequence_id"].nunique() <= -(-got["length"].sum() // 1024) + 2
    whole = packing.packed_sequences(docs, path).toPandas()
    assert sum(map(len, whole["ids"])) == got["length"].sum() and whole["ids"].map(len).max() <= 1024
    assert packing.packed_pieces(docs.limit(0), path).count() == 0
