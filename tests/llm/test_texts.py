"""Suffix dedup, token files, shards, pieces and the shingle join against brute force."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from carelens.llm import pieces, shards, shingle_join, suffix_dedup, token_store
from carelens.llm.common import WordMemo
from carelens.llm.components import components
from tests.llm.docs import SCHEMA, documents, frame, words

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BPE = public_tokenizers.path("byte_bpe_50k.json")


def removed(texts, width):
    seen = Counter(t[p : p + width] for t in texts for p in range(len(t) - width + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - width + 1):
            if seen[t[p : p + width]] > 1:
                gone[p : p + width] = True
        edges = np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        out.append((len(t), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("width, group", [(400, 20_000), (400, 2), (60, 20_000), (60, 3)])
def test_suffix_dedup(spark, width, group):
    rows = documents(copies=30)
    got = suffix_dedup.removal_digest(frame(spark, rows), width, group).collect()
    want = removed([(t or "").encode() for _, t, *_ in rows], width)
    assert Counter(map(tuple, got)) == Counter((r[0], *w) for r, w in zip(rows, want, strict=True))


def test_suffix_dedup_merges_shards(monkeypatch):
    rng = random.Random(4)
    core = bytes(rng.choice(b"ab") for _ in range(48))
    data, left, n = [], [], []
    for _ in range(40):
        a, b = (bytes(rng.choice(b"ab\0") for _ in range(k)) for k in (rng.randint(0, 12), 12))
        data.append(a + core + (b if rng.random() < 0.6 else b"ab" * 6))
        left.append(len(a))
        n.append(len(a) + 1)
    width = 60
    windows = [[d[i : i + width] for i in range(k)] for d, k in zip(data, n, strict=True)]
    # In a group windows are alike at equal offsets from the anchor only.
    seen = Counter((x - i, w) for ws, x in zip(windows, left, strict=True) for i, w in enumerate(ws))
    for shard in (3, 7, 1000):
        monkeypatch.setattr(suffix_dedup, "SHARD", shard)
        got = suffix_dedup.repeated_windows(np.zeros(40, int), np.array(left), np.array(n), data, width)
        for mask, ws, x in zip(got, windows, left, strict=True):
            assert [bool(m) for m in mask] == [seen[x - i, w] > 1 for i, w in enumerate(ws)]


def test_suffix_dedup_keeps_columns(spark):
    docs = frame(spark).withColumn("rid", F.lit("clash"))
    got = suffix_dedup.without_repeats(docs, 200)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    texts = [r["text"] for r in got.collect()]
    assert len(texts) == len(documents()) and None in texts
    assert suffix_dedup.without_repeats(docs.limit(0), 200).count() == 0
    assert suffix_dedup.removal_digest(docs.limit(0)).count() == 0


def test_token_files(spark):
    from tokenizers import Tokenizer

    library, upto, want = Tokenizer.from_file(BPE), 0, []
    rows = documents()
    for doc_id, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((doc_id, upto, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        upto += len(ids)
    got = token_store.token_digest(frame(spark, rows).withColumn("ids", F.lit(1)), BPE)
    assert Counter(map(tuple, got.collect())) == Counter(want)
    assert token_store.token_digest(frame(spark).limit(0), BPE).count() == 0


def test_words_are_coded_once_whatever_follows(monkeypatch):
    monkeypatch.setattr(token_store, "_coders", {})
    encode = token_store.coder(BPE)
    some = sorted({w for w in words(random.Random(6), 60).split()}) + ["été", "Ñu"]
    list(encode(["".join(f" {w}{s} \n" for w in some for s in ("", ",", ".", "!", ")"))]))
    assert token_store._coders[BPE].n < 1.5 * len(some)


def test_cut_words_are_those_of_the_library():
    from tokenizers import Tokenizer

    library, encode, rng = Tokenizer.from_file(BPE), token_store.coder(BPE), random.Random(8)
    parts = [*"abTe'sr ,.;|<>!?\"()-#&019\n\n  \t\réñß×÷Ж中—😀\u00a0\u3000\u0301\u2028\x1c\x85\0\x7f"]
    parts += ["<|endoftext|>", "endoftext", "'s", "'re", "'ll", "the ", "word.\n", "\n\n", "   ", " \n", "too,\n"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(20_000)]
    got = [ids.tolist() for _, flat, n in encode(texts) for ids in np.split(flat, np.cumsum(n)[:-1])]
    assert got == [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]


@pytest.mark.parametrize("limit", [100, 90])
def test_full_memo_keeps_words_met_again(limit):
    coded = []

    def code(new):
        coded.extend(new)
        return [np.frombuffer(w, np.uint8).astype(np.int32) for w in new]

    memo, hot = WordMemo(code, limit), "".join(f" hot{i}" for i in range(50)).encode()
    for k in range(6):
        texts = [hot, b"", "".join(f" cold{k}.{i}" for i in range(30)).encode()]
        codes, counts = memo.encode(texts)
        assert bytes(codes.astype(np.uint8)) == b"".join(texts) and counts.tolist() == list(map(len, texts))
        assert memo.n <= limit + 80
    times = Counter(w for w in coded if w.startswith(b" hot"))
    # Words met again stay if they fill no more than half of the limit.
    assert len(times) == 50 and (set(times.values()) == {1}) == (limit == 100)


def test_token_files_are_selective(spark, tmp_path):
    import pyarrow.parquet as pq

    path = str(tmp_path / "tokens")
    token_store.write_tokens(frame(spark), path, BPE)
    back = token_store.read_tokens(spark, path)
    assert len(back.where("doc_id = 7000").collect()) == 2
    files = [f for f in (tmp_path / "tokens").iterdir() if f.suffix == ".parquet"]
    column = pq.ParquetFile(max(files, key=lambda f: f.stat().st_size)).metadata.row_group(0).column(4)
    assert column.has_column_index or column.has_offset_index
    assert {"RLE_DICTIONARY", "DELTA_BINARY_PACKED"} & set(column.encodings)


def test_shards(spark):
    rows = documents(copies=60)
    got = shards.shard_digest(frame(spark, rows).withColumn("slot", F.lit(3)), 7).collect()
    size = lambda t: len((t or "").encode()) + 8
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((i, size(t), zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    counts = Counter(r["shard"] for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1 and set(counts) == set(range(7))
    for s in counts:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(counts[s]))
    assert {r["law"] for r in got} == {"rows"} and {r["grown_shard"] for r in got} == {None}
    assert shards.shard_digest(frame(spark).limit(0)).count() == 0


def test_shards_are_shuffled(spark, tmp_path):
    docs = spark.createDataFrame([(i, "a" * 50) for i in range(3000)], "doc_id bigint, text string").repartition(4)
    shards.write_shards(docs, str(tmp_path / "s"), 3, bucket_bytes=20_000)
    back = spark.read.parquet(str(tmp_path / "s")).orderBy("shard", "slot").toPandas()
    order = back["doc_id"].to_numpy()
    assert sorted(order) == list(range(3000))
    assert abs(np.corrcoef(order, np.arange(3000))[0, 1]) < 0.1
    assert len(set(map(tuple, (shards.fisher_yates(3, np.random.default_rng(i)) for i in range(80))))) == 6


def brute_path(unigram, text):
    """Best path of one word by plain recursion over all pieces."""
    scores = {p: unigram.words.scores[i] for i, p in reversed([(i, unigram.words.pieces[i]) for i in unigram.words.trie_ids()])}
    best = [(0.0, [])] + [None] * len(text)
    for i in range(len(text)):
        if best[i] is None or (i and text[i] & 0xC0 == 0x80):
            continue
        wide = next((j for j in range(i + 1, len(text)) if text[j] & 0xC0 != 0x80), len(text)) - i
        steps = [(j, scores[text[i:j]]) for j in range(i + 1, min(len(text), i + 50) + 1) if text[i:j] in scores]
        if not any(j == i + wide for j, _ in steps):
            steps.append((i + wide, unigram.unknown_score))
        for j, s in steps:
            if best[j] is None or best[i][0] + s > best[j][0]:
                best[j] = best[i][0] + s, [*best[i][1], (i, j)]
    return best[-1]


def test_pieces(spark):
    unigram, memo = pieces.model(MODEL)
    rng = random.Random(2)
    texts = [t or "" for _, t, *_ in documents()][:30] + ["a ﬁ ½ 漢字 😀", "naïve café", words(rng, 5)]
    raw = [unigram.prepared(t) for t in texts]
    codes, counts = memo.encode(raw)
    assert [b.decode() for b in unigram.decode(codes, counts)] == texts
    score = np.array(unigram.words.scores)
    for r, ids in list(zip(raw, np.split(codes, np.cumsum(counts)[:-1]), strict=True))[-12:]:
        if len(r) < 400 and r and not (set(ids.tolist()) & set(unigram.words.byte_ids.tolist())):
            assert abs(score[ids].sum() - brute_path(unigram, r)[0]) < 1e-6
    got = pieces.piece_digest(frame(spark), MODEL).collect()
    assert len(got) == len(documents()) and all(r["same"] for r in got)


def test_pieces_by_brute_force():
    class Tiny(pieces.Vocabulary):
        pass

    alphabet = [b"a", b"b", b" ", b"ab", b"ba", b"aab", b" a", b" ab", b"bb", b"abab"]
    rng = random.Random(5)
    scores = np.array([0.0] * 256 + [-rng.randint(1, 20) / 4 for _ in alphabet])
    unigram = pieces.Unigram(Tiny([bytes([b]) for b in range(256)] + alphabet, scores, np.arange(256, dtype=np.int32), [], 999))
    for _ in range(200):
        word = (b" " if rng.random() < 0.5 else b"") + "".join(rng.choice("abé") for _ in range(rng.randint(1, 12))).encode()
        ids = unigram.code([word, b"ab"])[0]
        spans = brute_path(unigram, word)[1]
        want = []
        for i, j in spans:
            want += [256 + alphabet.index(word[i:j])] if word[i:j] in alphabet else list(word[i:j])
        assert ids.tolist() == want


def test_piece_columns(spark):
    docs = frame(spark).withColumn("ids", F.lit(1))
    back = pieces.decode_column(pieces.encode_column(docs, MODEL), MODEL)
    for r in back.collect():
        assert r["decoded"] == (r["text"] or "")
    assert pieces.encode_column(docs.limit(0), MODEL).count() == 0


def shingles(text, size=5):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    w = [x for x in low.split(" ") if x]
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def jaccard_components(rows):
    sets = {i: shingles(t) for i, t, *_ in rows if i is not None}
    part = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((part[a], part[b]))
                part = {k: x if v == y else v for k, v in part.items()}
    return sets, part


@pytest.mark.parametrize("short, fragment", [(8, 2_000_000), (2, 300)])
def test_shingle_join(spark, monkeypatch, short, fragment):
    monkeypatch.setattr(shingle_join, "SHORT_LIST", short)
    monkeypatch.setattr(shingle_join, "FRAGMENT", fragment)
    monkeypatch.setattr(shingle_join, "NEXT", 1)
    rng = random.Random(9)
    base = words(rng, 120).split()
    rows = [r for r in documents() if r[0] != 7000]
    for k in range(60):  # near copies whose similarity lies on both sides of the bound
        w = list(base)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = words(rng, 1)
        rows.append((20_000 + rng.randrange(10**6), " ".join(w), "en", "s", 1))
    sets, part = jaccard_components(rows)
    docs = frame(spark, rows).withColumn("node", F.lit("clash"))
    got = shingle_join.shingle_components(docs).collect()
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None} == part
    assert {r["doc_id"]: r["n_shingles"] for r in got if r["doc_id"] is not None} == {i: len(s) for i, s in sets.items()}
    assert [r["component_id"] for r in got if r["doc_id"] is None] == [None] and len(got) == len(rows)


def test_shingle_join_edges(spark):
    assert shingle_join.shingle_components(frame(spark).limit(0)).count() == 0
    same = [(i, "the very same words in each of them", "en", "s", 1) for i in (5, 3, 9, 3)]
    got = shingle_join.shingle_components(spark.createDataFrame(same, SCHEMA)).collect()
    assert [r["component_id"] for r in got] == [3] * 4


def test_unconnected_pairs_are_whole():
    rng = np.random.default_rng(3)
    n = rng.integers(20, 60, 50)
    place = rng.integers(0, 6, 50)
    import pandas as pd

    rows = pd.DataFrame({"a": np.arange(50), "n": n, "place": place, "component": np.arange(50) // 10, "parity": [bytes(128)] * 50})
    got = set(map(tuple, shingle_join._unconnected(80)((1,), rows).to_numpy().tolist()))
    want = {
        (i, j)
        for i in range(50)
        for j in range(i + 1, 50)
        if i // 10 != j // 10 and min(n[i] - place[i], n[j] - place[j]) >= -(-80 * (n[i] + n[j]) // 180)
    }
    assert got == want


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(60)] + [(200, 100), (150, 200), (7, 7)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(80)]
    part = {x: x for e in links for x in e if e[0] != e[1]}
    for a, b in links * 2:
        if a != b:
            x, y = sorted((part[a], part[b]))
            part = {k: x if v == y else v for k, v in part.items()}
    got = components(spark.createDataFrame([*links, (None, 3)], "a bigint, b bigint")).collect()
    assert {r["id"]: r["component"] for r in got} == part


def test_pairs_of_a_hot_shingle_alone(spark, monkeypatch):
    """Every list counts as hot, so lists are dealt over salts: no linked pair may get lost between the buckets."""
    monkeypatch.setattr(shingle_join, "HOT", -0.5)
    rng = random.Random(3)
    rows = []
    for k in range(60):
        base = words(rng, 40).split()
        for j in range(2):
            rows.append((2 * k + j, " ".join([*base, *(f"tail{k}{j}",) * j]), "en", "s", 1))
    got = {r["doc_id"]: r["component_id"] for r in shingle_join.shingle_components(frame(spark, rows)).collect()}
    assert got == {i: i - i % 2 for i in range(120)}


def test_repeated_ids_count_with_their_own_texts(spark):
    rng = random.Random(4)
    one, two = words(rng, 60), words(rng, 60)
    rows = [(1, one, "en", "s", 1), (1, two, "en", "s", 1), (2, one + " more", "en", "s", 1), (3, two + " more", "en", "s", 1)]
    got = {r["doc_id"]: r["component_id"] for r in shingle_join.shingle_components(frame(spark, rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 1}


def test_blocks_of_a_long_list_meet_once(spark, monkeypatch):
    monkeypatch.setattr(shingle_join, "BLOCK", 7)
    rng = random.Random(5)
    rows = [(1, i, rng.randint(20, 60), 0, i % 5, b"\0" * 128) for i in range(150)]
    rest = spark.createDataFrame(rows, "shingle bigint, a bigint, n int, place int, component bigint, parity binary")
    sent = shingle_join._block_pairs(rest, 80).toPandas()
    sent["x"], sent["y"] = sent["x"].map(tuple), sent["y"].map(tuple)
    met = {}
    for (x, y, same), part in sent.groupby(["x", "y", "same"]):
        left, right = (part, part) if same else (part[part["side"] == 0], part[part["side"] == 1])
        for a in left["a"]:
            for b in right["a"]:
                if a != b:
                    met.setdefault((min(a, b), max(a, b)), set()).add((x, y))
    sizes = {r[1]: r[2] for r in rows}
    wanted = {(a, b) for a in sizes for b in sizes if a < b and min(sizes[a], sizes[b]) >= 0.8 * max(sizes[a], sizes[b])}
    assert wanted <= set(met) and all(len(v) == 1 for v in met.values())


def test_candidates_that_hang_together_are_counted_once(spark, monkeypatch):
    """Texts that share a passage with the next one are one long chain of candidates: its length is no factor of the work."""
    rng = random.Random(11)
    passage = [words(rng, 30) for _ in range(61)]
    rows = [(i, " ".join([passage[i], words(rng, 5), passage[i + 1]]), "en", "s", 1) for i in range(60)]
    rows += [(100 + i, rows[i][1] + " more", "en", "s", 1) for i in range(0, 60, 6)]
    met, overlaps = spark.sparkContext.accumulator(0), shingle_join._overlaps

    def counted(batches):
        def seen():
            for batch in batches:
                met.add(batch.num_rows)
                yield batch

        yield from overlaps(seen())

    monkeypatch.setattr(shingle_join, "_overlaps", counted)
    monkeypatch.setattr(shingle_join, "FRAGMENT", 50)
    monkeypatch.setattr(shingle_join, "SKETCH_BITS", 6)  # it tells no more than a full one of a large table
    got = {r["doc_id"]: r["component_id"] for r in shingle_join.shingle_components(frame(spark, rows)).collect()}
    assert got == jaccard_components(rows)[1] and got[100] == 0 and got[1] == 1
    assert 0 < met.value < 500


def test_short_runs_are_compared_as_long_ones(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(8)
    rows, runs, close = [], [], rng.integers(0, 256, 128, np.uint8)
    for shingle in range(40):
        same, n = bool(shingle % 2), int(rng.integers(2, 30))
        side = np.zeros(n, int) if same else np.sort(rng.integers(0, 2, n))
        runs.append((same, []))
        for k in range(n):
            parity = close.copy()
            parity[rng.integers(0, 128, 3)] ^= np.uint8(1 << int(rng.integers(0, 8)))
            row = (shingle * 100 + k, int(rng.integers(20, 60)), int(rng.integers(0, 6)), int(rng.integers(0, 4)), parity.tobytes())
            runs[-1][1].append((int(side[k]), row))
            rows.append((shingle, 1, 0, 1, 0, same, int(side[k]), *row))
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=[str(k) for k in range(12)])

    def linked(x, y):
        both = x[1] + y[1]
        least = -(-80 * both // 180)
        differ = sum((a ^ b).bit_count() for a, b in zip(x[4], y[4], strict=True))
        return x[3] != y[3] and min(x[1] - x[2], y[1] - y[2]) >= least and differ <= both - 2 * least

    want = {(x[0], y[0]) for same, run in runs for s, x in run for t, y in run if x[0] < y[0] and (same or s != t) and linked(x, y)}
    for few, at_once in ((4096, 1 << 19), (4096, 50), (0, 50), (200, 300)):
        monkeypatch.setattr(shingle_join, "FEW", few)
        monkeypatch.setattr(shingle_join, "AT_ONCE", at_once)
        parts = [batch.slice(a, 77) for a in range(0, len(rows), 77)]
        got = [p for b in shingle_join._unconnected_runs(80)(iter(parts)) for p in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        assert set(got) == want and len(want) > 50


def test_sets_of_a_hub_meet_it_in_one_block_each(spark, monkeypatch):
    monkeypatch.setattr(shingle_join, "GROUP", 10)
    found = spark.createDataFrame([(0, b, 40, 40 + b) for b in range(1, 96)] + [(5, 9, 45, 49)], "a bigint, b bigint, na int, nb int")
    rows = shingle_join._groups(found).collect()
    first = {(r["g"], r["block"]) for r in rows if r["node"] == r["g"]}
    others = [r for r in rows if r["node"] != r["g"]]
    assert Counter((r["g"], r["node"]) for r in others) == Counter([(0, b) for b in range(1, 96)] + [(5, 9)])
    assert {(r["g"], r["block"]) for r in others} <= first and len(first) == 11
    assert max(Counter((r["g"], r["block"]) for r in others).values()) < 30
