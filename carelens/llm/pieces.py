"""Unigram pieces: Viterbi over a double-array trie of pieces with log scores, byte fallback, white-space marker.

A piece holds the marker of a space at its start only, so the best path of a text is that of its words, one after
another; words are coded once per worker and kept (``WordMemo``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from carelens.llm.common import WordMemo, chunks, exploded, slices, whole_text

MARKER = "▁"
#: What a character outside the vocabulary costs beyond the lowest score.
UNKNOWN_PENALTY = 10.0
#: Words of more bytes are coded one by one.
LONG_WORD = 48


@dataclass
class Vocabulary:
    """Pieces as bytes, with a space for the marker.  ``byte_ids``: the piece of each byte.  ``hidden``: ids without text."""

    pieces: list[bytes]
    scores: np.ndarray
    byte_ids: np.ndarray
    hidden: list[int]
    unknown: int
    prefix: bool = True

    @classmethod
    def from_model(cls, path: str) -> Vocabulary:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        pieces, byte_ids, hidden = [], np.zeros(256, np.int32), []
        for i in range(len(model)):
            text = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(text[3:5], 16)] = i
                pieces.append(bytes([int(text[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                hidden.append(i)
                pieces.append(b"")
            else:
                pieces.append(text.replace(MARKER, " ").encode())
        scores = np.array([model.get_score(i) for i in range(len(model))])
        return cls(pieces, scores, byte_ids, hidden, model.unk_id(), model.encode("a", out_type=str)[0].startswith(MARKER))

    def trie_ids(self) -> list[int]:
        apart = {*self.hidden, *self.byte_ids.tolist()}
        return [i for i in range(len(self.pieces)) if i not in apart]


class DoubleArray:
    """A trie in two arrays: the child of state s by byte c is base[s] + c + 1 if check there is s; value: the piece."""

    def __init__(self, keys: dict[bytes, int]) -> None:
        children: list[dict[int, int]] = [{}]
        value = [-1]
        for key, number in sorted(keys.items()):
            at = 0
            for c in key:
                if c not in children[at]:
                    children[at][c] = len(children)
                    children.append({})
                    value.append(-1)
                at = children[at][c]
            value[at] = number
        size = 4 * len(children) + 4096
        self.base, self.check, self.value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        taken, place, hint = np.zeros(size, bool), {0: 0}, 1
        taken[0] = True
        for node, kids in enumerate(children):
            if not kids:
                continue
            codes = sorted(c + 1 for c in kids)
            at = hint
            while True:  # the first base from the hint on under which all children's places are free
                window = min(512, size - at - 257)
                assert window > 0, "the arrays are too small"
                free = ~taken[at + codes[0] : at + codes[0] + window]
                for c in codes[1:]:
                    free &= ~taken[at + c : at + c + window]
                if free.any():
                    at += int(free.argmax())
                    break
                at += window
            if len(codes) == 1 and at > hint + 256:
                hint = at - 256  # all before is full
            state = place[node]
            self.base[state] = at
            for c in codes:
                taken[at + c] = True
                self.check[at + c], self.value[at + c] = state, value[kids[c - 1]]
                place[kids[c - 1]] = at + c

    def matches(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Every piece in ``data``: where it starts, its bytes, its number.  ends: for each position, where its word ends."""
        at = np.arange(len(data))
        state = np.zeros(len(data), np.int64)
        found: list[tuple[np.ndarray, int, np.ndarray]] = []
        length = 0
        while len(at):
            inside = at + length < ends[at]
            at, state = at[inside], state[inside]
            child = self.base[state] + data[at + length].astype(np.int64) + 1
            there = (child < len(self.check)) & (self.check[np.minimum(child, len(self.check) - 1)] == state)
            at, state = at[there], child[there]
            length += 1
            number = self.value[state]
            found.append((at[number >= 0], length, number[number >= 0]))
        starts = np.concatenate([f[0] for f in found])
        lengths = np.concatenate([np.full(len(f[0]), f[1]) for f in found])
        return starts, lengths, np.concatenate([f[2] for f in found])


class Unigram:
    def __init__(self, words: Vocabulary) -> None:
        self.words = words
        keys: dict[bytes, int] = {}
        for i in words.trie_ids():
            keys.setdefault(words.pieces[i], i)
        assert not any(b" " in k.lstrip(b" ") for k in keys), "a piece holds a space behind another character"
        self.trie = DoubleArray(keys)
        self.unknown_score = float(words.scores[words.trie_ids()].min()) - UNKNOWN_PENALTY
        sizes = np.array([len(p) for p in words.pieces], np.int64)
        self.piece_bytes = np.frombuffer(b"".join(words.pieces), np.uint8)
        self.piece_start, self.piece_size = np.cumsum(sizes) - sizes, sizes

    def code(self, words: list[bytes]) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(words)
        by_size: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_size.setdefault(len(w) if len(w) > LONG_WORD else (len(w) + 7) // 8 * 8, []).append(i)
        for numbers in by_size.values():
            for k in range(0, len(numbers), 1 << 15):
                part = numbers[k : k + (1 << 15)]
                for i, ids in zip(part, self._paths([words[i] for i in part]), strict=True):
                    out[i] = ids
        return out

    def _paths(self, words: list[bytes]) -> list[np.ndarray]:
        """The best path of each word; of equal paths the one whose last pieces start earliest."""
        sizes = np.array([len(w) for w in words], np.int64)
        n, longest = len(words), int(sizes.max())
        data = np.frombuffer(b"".join(words), np.uint8)
        begin = np.cumsum(sizes) - sizes
        word = np.repeat(np.arange(n), sizes)
        starts, lengths, numbers = self.trie.matches(data, (begin + sizes)[word])
        # A character that is no piece itself: an unknown one.
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        wide = np.diff(np.append(lead, len(data)))
        wide = np.minimum(wide, (begin + sizes)[word[lead]] - lead)
        single = np.zeros(len(data), bool)
        char_bytes = np.zeros(len(data), np.int64)
        char_bytes[lead] = wide
        single[starts[lengths == char_bytes[starts]]] = True
        lack = lead[~single[lead]]
        edges = np.concatenate([starts, lack]), np.concatenate([lengths, char_bytes[lack]])
        number = np.concatenate([numbers, np.full(len(lack), self.words.unknown)])
        score = np.concatenate([self.words.scores[numbers], np.full(len(lack), self.unknown_score)])
        of = word[edges[0]]
        offset = edges[0] - begin[of]
        order = np.lexsort((edges[1], offset))
        of, offset, length, number, score = (x[order] for x in (of, offset, edges[1], number, score))
        best = np.full((n, longest + 1), -np.inf)
        best[:, 0] = 0.0
        by, size = np.zeros((n, longest + 1), np.int32), np.zeros((n, longest + 1), np.int64)
        # Runs of edges with one offset and one length: no two of them end at the same place.
        bounds = np.flatnonzero((np.diff(offset, prepend=-1) != 0) | (np.diff(length, prepend=-1) != 0))
        for a, b in zip(bounds, np.append(bounds[1:], len(of)), strict=True):
            j, step, w = int(offset[a]), int(length[a]), of[a:b]
            total = best[w, j] + score[a:b]
            better = total > best[w, j + step]
            w = w[better]
            best[w, j + step] = total[better]
            by[w, j + step] = number[a:b][better]
            size[w, j + step] = step
        # Back from the ends, all words at once.
        live, at = np.arange(n), sizes.copy()
        steps_of, steps_id = [], []
        while len(live):
            here = at[live]
            live, here = live[here > 0], here[here > 0]
            steps_of.append(live)
            steps_id.append(np.stack([by[live, here].astype(np.int64), begin[live] + here - size[live, here], size[live, here]]))
            at[live] = here - size[live, here]
        of = np.concatenate(steps_of)[::-1]
        ids, place, size = np.concatenate(steps_id, axis=1)[:, ::-1]
        order = np.argsort(of, kind="stable")
        of, ids, place, size = of[order], ids[order], place[order], size[order]
        unknown = ids == self.words.unknown
        if unknown.any():  # one piece for each byte of it
            repeat = np.where(unknown, size, 1)
            spread = self.words.byte_ids[data[exploded(place, repeat)]]
            ids, of = np.where(np.repeat(unknown, repeat), spread, np.repeat(ids, repeat)), np.repeat(of, repeat)
        return np.split(ids.astype(np.int32), np.searchsorted(of, np.arange(1, n)))

    def prepared(self, text: str) -> bytes:
        raw = text.encode("utf-8").replace(MARKER.encode(), b" ")
        return b" " + raw if raw and self.words.prefix else raw

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of each run of ids, without the space that encoding puts first."""
        sizes = self.piece_size[ids]
        data = self.piece_bytes[exploded(self.piece_start[ids], sizes)].tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        skip = 1 if self.words.prefix else 0
        return [data[a + skip : b] if b > a else b"" for a, b in zip(ends, ends[1:], strict=False)]


_models: dict[str, tuple[Unigram, WordMemo]] = {}


def model(path: str) -> tuple[Unigram, WordMemo]:
    """The model and its kept words, one for each worker process."""
    if path not in _models:
        unigram = Unigram(Vocabulary.from_model(path))
        _models[path] = unigram, WordMemo(unigram.code)
    return _models[path]


def encode_column(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds ``ids``, the pieces of each whole text (NULL: none).  A column of that name is replaced."""
    docs = docs.drop(ids)
    names = docs.columns
    place = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unigram, memo = model(path)
        for batch in slices(batches):
            raw = [unigram.prepared(t or "") for t in batch.column(place).to_pylist()]
            for a, b in chunks(raw):
                codes, counts = memo.encode(raw[a:b])
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(codes.astype(np.int32)))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*names, ids])

    return docs.mapInArrow(run, StructType([*docs.schema, StructField(ids, ArrayType(IntegerType()))]))


def decode_column(docs: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds ``text``, the text of ``ids`` (NULL: empty); bytes that are no UTF-8 become replacement characters."""
    docs = docs.drop(text)
    names = docs.columns
    place = names.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unigram, _ = model(path)
        for batch in slices(batches):
            lists = batch.column(place)
            counts = np.array([len(x) if x is not None else 0 for x in lists], np.int64)
            codes = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            texts = [x.decode("utf-8", "replace") for x in unigram.decode(codes, counts)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*names, text])

    return docs.mapInArrow(run, StructType([*docs.schema, StructField(text, StringType())]))


def piece_digest(docs: DataFrame, path: str) -> DataFrame:
    """Per document: pieces, bytes coded by fallback, CRC-32 of the ids (little-endian, 32 bits), log score of the best
    path, and what decoding gives back: its bytes and whether it is the text itself (a marker in the text is a space).

    A NULL or empty text has no pieces and comes back empty.  Each row is coded on its own, whether it repeats a doc_id or
    has none; other columns are ignored, and an empty table gives no rows.
    """
    import zlib

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    schema = (
        "doc_id bigint, n_pieces bigint, n_fallback bigint, ids_crc32 bigint, log_score double, n_bytes bigint, same boolean"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unigram, memo = model(path)
        is_byte = np.zeros(len(unigram.words.pieces), np.int64)
        is_byte[unigram.words.byte_ids] = 1
        # Of an unknown character's bytes the first carries its score.
        score = np.where(is_byte == 1, 0.0, unigram.words.scores)
        for batch in slices(batches):
            raw = [unigram.prepared(t) for t in batch.column(1).to_pylist()]
            for a, b in chunks(raw):
                codes, counts = memo.encode(raw[a:b])
                ends = np.cumsum(counts)
                sums = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[np.concatenate([[0], ends])])  # noqa: B023, E731
                lead = is_byte[codes] * ((unigram.piece_bytes[unigram.piece_start[codes]] & 0xC0) != 0x80)
                bounds = np.concatenate([[0], ends]).tolist()
                crc = [zlib.crc32(codes[x:y].astype("<u4").tobytes()) for x, y in zip(bounds, bounds[1:], strict=False)]
                back = unigram.decode(codes, counts)
                skip = 1 if unigram.words.prefix else 0
                same = [x == y[skip:] for x, y in zip(back, raw[a:b], strict=True)]
                arrays = [
                    batch.column(0).slice(a, b - a), pa.array(counts), pa.array(sums(is_byte[codes])), pa.array(crc, pa.int64()),
                    pa.array(sums(score[codes] + lead * unigram.unknown_score)), pa.array([len(x) for x in back], pa.int64()),
                    pa.array(same, pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=[x.split()[0] for x in schema.split(", ")])

    return rows.mapInArrow(run, schema)
