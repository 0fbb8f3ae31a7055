"""Weak labels: labellers that overlap, their accuracies by expectation-maximisation, and a hashed linear scorer.

Heuristic labellers vote on each document: those that look for one defect say bad or nothing, those that look for a sound
text say fine or nothing.  Where a table of judgements has the document, that is one more labeller.  EM over the counts of
vote patterns of all documents (there are few patterns, however many documents) gives each labeller's accuracy, that is how
often it is right when it votes, and each pattern's posterior; silence tells nothing.  Posteriors train a sparse logistic scorer on hashed words,
word beginnings and shape features, and the scorer alone decides.  Quality and toxicity are two such models.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from carelens.llm.common import Rolling, chunks, joined, mix, slices, stored, whole_text

#: Words of abuse, lower case.
INSULTS = (
    "idiot", "idiots", "moron", "morons", "stupid", "dumb", "fool", "clown", "loser", "losers", "scum", "trash", "garbage",
    "worthless", "pathetic", "disgusting", "hateful", "imbecile", "vermin", "filth",
)
#: Hash buckets of the scorer.
BUCKETS = 1 << 18
#: Judged documents that train the scorers: the least by hash, whatever the size of the corpus.
SAMPLE = 12_000
#: With fewer judged documents than this, others that some labeller votes on join the sample.
LEAST_JUDGED = 2_000
#: Entries of the sample that training takes at a time.
BLOCK = 1 << 19
PREFIXES = (4, 6, 8)
_rolling = Rolling(31)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(0x80, 0x100)]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SYMBOL = ~_WORD & ~_SPACE
_SYMBOL[[ord(c) for c in ".,;:'\"()-?"]] = False
QUALITY, TOXIC = ("symbols", "capitals", "echoes", "marks", "variety", "plain"), ("insults", "insult_share", "clean")
TASKS = ("quality", "toxic")
#: L1 penalty of each scorer, from held-out judgements: quality shows in a few shapes, abuse in many words.
PENALTY = {"quality": 0.008, "toxic": 0.003}
#: A labeller that votes is right more often than not, and none is beyond doubt.
LEAST_RIGHT, MOST_RIGHT = 0.55, 0.999


def _insult_hashes() -> np.ndarray:
    data, offsets = joined([w.encode() for w in INSULTS])
    return np.unique(_rolling.spans(_rolling.prefix(data), offsets[:-1], offsets[1:]))


_INSULTS = _insult_hashes()


@dataclass
class Shapes:
    """Figures of each text, the votes of each labeller (1 bad, 0 fine, -1 nothing), and its features by bucket."""

    votes: np.ndarray
    owner: np.ndarray
    bucket: np.ndarray


def _votes_where(mask: np.ndarray, vote: int) -> np.ndarray:
    return np.where(mask, vote, -1)


def shapes(texts: list[bytes], english: np.ndarray, features: bool = True) -> Shapes:
    n = len(texts)
    data, offsets = joined(texts)
    size = np.diff(offsets)
    total = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets]).astype(float)
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True

    def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = np.flatnonzero(mask & (edge[:-1] | ~np.concatenate([[False], mask[:-1]])))
        return starts, np.flatnonzero(mask & (edge[1:] | ~np.concatenate([mask[1:], [False]]))) + 1

    low = _LOWER[data]
    sums = _rolling.prefix(low)
    starts, ends = runs(_WORD[data])
    words = _rolling.spans(sums, starts, ends)
    of = np.searchsorted(offsets, starts, "right") - 1
    count = np.bincount(of, minlength=n).astype(float)
    tokens = runs(~_SPACE[data])
    token_of = np.searchsorted(offsets, tokens[0], "right") - 1
    token_count = np.bincount(token_of, minlength=n).astype(float)
    bare = np.bincount(token_of[_SYMBOL[data[tokens[1] - 1]]], minlength=n) if len(tokens[0]) else np.zeros(n)
    echo = np.zeros(len(words), bool)
    echo[1:] = (words[1:] == words[:-1]) & (of[1:] == of[:-1])
    order = np.lexsort((words, of))
    fresh = np.ones(len(words), bool)
    fresh[1:] = (words[order][1:] != words[order][:-1]) | (of[order][1:] != of[order][:-1])
    distinct = np.bincount(of[order][fresh], minlength=n)
    insults = np.bincount(of[np.isin(words, _INSULTS)], minlength=n).astype(float)
    per = lambda a, b: a / np.maximum(b, 1)
    symbols, capitals = per(total(_SYMBOL[data]), size), per(total((data >= 65) & (data <= 90)), total(_WORD[data]))
    echoes, marks, variety = per(np.bincount(of[echo], minlength=n), count), per(bare, token_count), 1 - per(distinct, count)
    long = np.where(count >= 40, variety, 0.5)  # short texts repeat few words anyway
    few = count < 3
    sound = (symbols < 0.03) & (capitals < 0.15) & (echoes < 0.03) & (marks < 0.08) & ((count < 40) | (variety < 0.8))
    votes = np.stack(
        [
            _votes_where(symbols > 0.08, 1), _votes_where(capitals > 0.5, 1), _votes_where(echoes > 0.3, 1), _votes_where(marks > 0.3, 1),
            _votes_where((count >= 40) & (variety > 0.8), 1), _votes_where(sound, 0),
            _votes_where(insults > 0, 1), _votes_where(per(insults, count) > 0.002, 1), _votes_where((insults == 0) & english & ~few, 0),
        ],
        axis=1,
    )
    votes[few, : len(QUALITY)] = -1
    if not features:
        return Shapes(votes, of[:0], words[:0].astype(np.int32))
    keys, owner = [words[order][fresh]], [of[order][fresh]]
    for length in PREFIXES:
        far = ends - starts >= length
        keys.append(_rolling.spans(sums, starts[far], starts[far] + length) ^ np.uint64(length))
        owner.append(of[far])
    for k, (value, step) in enumerate(((symbols, 0.02), (capitals, 0.1), (echoes, 0.05), (marks, 0.05), (long, 0.1))):
        bins = np.minimum(np.floor(value / step), 12).astype(np.uint64)
        keys.append(mix(bins + np.uint64(1000 * (k + 1))))
        owner.append(np.arange(n))
    for j, vote in enumerate(votes.T):
        keys.append(mix(np.full(int((vote == 1).sum()), 77_000 + j, np.uint64)))
        owner.append(np.flatnonzero(vote == 1))
    bucket = (mix(np.concatenate(keys)) % np.uint64(BUCKETS)).astype(np.int64)
    both = np.unique(np.concatenate(owner) * BUCKETS + bucket)
    return Shapes(votes, both // BUCKETS, (both % BUCKETS).astype(np.int32))


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray, float]:
    """Posterior of bad for each vote pattern, P(vote | class) of each labeller ([labeller, class, vote + 1]), and the prior.

    Labellers start 0.9 right when they vote.  Whether they vote is alike in both classes, so silence moves no posterior: a
    judged document is not outvoted by labellers that look for something else.  The prior is that of documents with votes.
    """
    bad, fine = (patterns == 1).astype(float), (patterns == 0).astype(float)
    said, voted = counts @ (bad + fine), (patterns >= 0).any(axis=1)
    right, prior = np.full(patterns.shape[1], 0.9), 0.15
    post = np.full(len(counts), prior)
    for _ in range(rounds):
        odds = np.log(right / (1 - right))
        margin = (bad - fine) @ odds + np.log(prior / (1 - prior))
        post = 1 / (1 + np.exp(-np.clip(margin, -60, 60)))
        agreed = (counts * post) @ bad + (counts * (1 - post)) @ fine
        right = np.clip((agreed + 4) / (said + 5), LEAST_RIGHT, MOST_RIGHT)
        prior = float(np.clip((counts * post)[voted].sum() / max(1.0, counts[voted].sum()), 1e-4, 0.5))
    silent = 1 - said / max(1.0, counts.sum())
    known = np.stack([np.stack([silent, (1 - silent) * (1 - x), (1 - silent) * x], axis=1) for x in (1 - right, right)], axis=1)
    return post, known, prior


def _sums(size: int, index: np.ndarray, values: np.ndarray | None = None, at: np.ndarray | None = None) -> np.ndarray:
    """Sums of ``values[at]`` (ones without values) by ``index``, block by block: no copy as long as the sample."""
    total = np.zeros(size)
    for a in range(0, len(index), BLOCK):
        part = slice(a, a + BLOCK)
        total += np.bincount(index[part], None if values is None else values[at[part]], size)
    return total


def frequent(owner: np.ndarray, bucket: np.ndarray, least: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Entries whose bucket is seen ``least`` times."""
    keep = (_sums(BUCKETS, bucket) >= least)[bucket]
    return owner[keep], bucket[keep]


def train(owner: np.ndarray, bucket: np.ndarray, target: np.ndarray, penalty: float, rounds: int = 250) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic scorer with an L1 penalty, by accelerated proximal steps over the whole sample."""
    n = len(target)
    if not n:
        return np.zeros(BUCKETS, np.float32), -1.0
    # Each class weighs alike, so a rare one is not drowned.
    share = np.clip(target.mean(), 0.02, 0.98)
    weight = target * 0.5 / share + (1 - target) * 0.5 / (1 - share)
    w, z, bias, zb, t = np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, 0.0, 1.0
    scale = 1 / np.sqrt(np.maximum(_sums(BUCKETS, bucket), 1) / n + 1e-3)  # rare features step further
    step = 4.0 / max(1.0, _sums(n, owner, scale**2, bucket).mean())
    for _ in range(rounds):
        margin = _sums(n, owner, z, bucket) + zb
        error = weight * (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - target) / n
        grad = _sums(BUCKETS, bucket, error, owner)
        new = z - step * scale**2 * grad
        new = np.sign(new) * np.maximum(np.abs(new) - step * scale**2 * penalty, 0)
        new_b = zb - step * error.sum()
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, zb = new + (t - 1) / t_next * (new - w), new_b + (t - 1) / t_next * (new_b - bias)
        w, bias, t = new, new_b, t_next
    return w.astype(np.float32), float(bias)


def _texts_of(batch: pa.RecordBatch) -> tuple[list[bytes], np.ndarray]:
    return [t.encode("utf-8") for t in batch.column(1).to_pylist()], np.array([x == "en" for x in batch.column(2).to_pylist()], bool)


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts, english = _texts_of(batch)
        for a, b in chunks(texts):
            votes = shapes(texts[a:b], english[a:b], False).votes.astype(np.int8)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *(pa.array(v) for v in votes.T.copy())], names=["doc_id", *QUALITY, *TOXIC])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts, english = _texts_of(batch)
        for a, b in chunks(texts):
            found = shapes(texts[a:b], english[a:b])
            sizes = np.bincount(found.owner, minlength=b - a)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(found.bucket))
            yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(a, b - a) for k in (0, 3, 4)), lists], names=["doc_id", "quality", "toxic", "buckets"])


@dataclass
class Model:
    """Weights of each task, and what EM found: accuracies by labeller and the prior, for reports."""

    weights: dict[str, tuple[np.ndarray, float]]
    accuracies: dict[str, dict[str, float]]
    priors: dict[str, float]


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Votes and EM cover all of ``docs``; the scorers learn from at most ``sample`` judged ones.

    ``labels`` (doc_id, quality, toxic) may judge some documents, several times or with NULLs (the worst judgement
    counts, NULL is none); without labels the heuristics decide alone.
    """
    columns = docs.columns
    lang = F.col("lang") if "lang" in columns else F.lit(None).cast("string")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"), lang.alias("lang"))
    judged = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.coalesce(F.max(1 - F.col("quality")), F.lit(-1)).cast("tinyint").alias("j_quality"), F.coalesce(F.max("toxic"), F.lit(-1)).cast("tinyint").alias("j_toxic")
    )
    names = [*QUALITY, *TOXIC]
    votes = rows.mapInArrow(_votes, "doc_id bigint, " + ", ".join(f"{c} tinyint" for c in names))
    votes = votes.join(judged, "doc_id", "left")
    # Few bytes a row, read for the counts and for the sample: the texts are not voted on again.
    votes = stored(votes.withColumns({c: F.coalesce(c, F.lit(-1)).cast("tinyint") for c in ("j_quality", "j_toxic")}), "votes")
    # 2**9 patterns by 9 judgements at most, of which those that occur come back.
    table = votes.groupBy(*names, "j_quality", "j_toxic").agg(F.count("*").alias("n")).collect()
    own = {"quality": [*QUALITY, "j_quality"], "toxic": [*TOXIC, "j_toxic"]}
    posterior, accuracies, priors = {}, {}, {}
    for task, voters in own.items():
        counts: dict[tuple, int] = {}
        for r in table:
            key = tuple(r[c] for c in voters)
            counts[key] = counts.get(key, 0) + r["n"]
        patterns = np.array(list(counts) or [(-1,) * len(voters)], np.int64)
        post, known, priors[task] = expectation_maximisation(patterns, np.array(list(counts.values()) or [1], float))
        # Where nobody votes there is nothing to learn from.
        learnt = [(*p, q) for p, q in zip(patterns.tolist(), post.tolist(), strict=True) if max(p) >= 0]
        schema = ", ".join([*(f"{c} tinyint" for c in voters), f"{task} double"])
        posterior[task] = docs.sparkSession.createDataFrame(learnt, schema)
        accuracies[task] = {c: float(known[j, 1, 2] / max(1e-9, known[j, 1, 1:].sum())) for j, c in enumerate(voters)}

    # The judged documents of least hash; where few are judged, others that have votes join them.
    has = (F.col("j_quality") >= 0) | (F.col("j_toxic") >= 0)
    n_docs, n_judged = sum(r["n"] for r in table), sum(r["n"] for r in table if r["j_quality"] >= 0 or r["j_toxic"] >= 0)
    pick = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    near = votes.where(has & (pick < sample / max(1, n_judged)))
    wanted = sample - n_judged if n_judged < min(sample, LEAST_JUDGED) else 0
    rest = votes.where(~has & (pick < wanted / max(1, n_docs - n_judged)))
    chosen = stored(near.union(rest).dropDuplicates(["doc_id"]), "sample")
    for task in TASKS:
        chosen = chosen.join(F.broadcast(posterior[task]), own[task], "left")
    chosen = chosen.select("doc_id", *TASKS)
    learnt = rows.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "lang", *TASKS).mapInArrow(_features, "doc_id bigint, quality double, toxic double, buckets array<int>")
    kept = learnt.toArrow()
    buckets = kept["buckets"].combine_chunks()
    buckets = buckets.combine_chunks() if isinstance(buckets, pa.ChunkedArray) else buckets
    flat = buckets.flatten().to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(kept.num_rows, dtype=np.int32), np.diff(buckets.offsets.to_numpy()))
    targets = {t: kept[t].to_numpy(zero_copy_only=False) for t in TASKS}  # NaN where the task has no vote
    owner, flat = frequent(owner, flat)
    del kept, buckets  # the driver holds one copy of the sample
    return Model({t: _trained(owner, flat, targets[t], PENALTY[t]) for t in TASKS}, accuracies, priors)


def _trained(owner: np.ndarray, bucket: np.ndarray, target: np.ndarray, penalty: float) -> tuple[np.ndarray, float]:
    """``train`` over the documents that have a target."""
    has = ~np.isnan(target)
    if has.all():
        return train(owner, bucket, target, penalty)
    place = (np.cumsum(has) - 1).astype(np.int32)
    keep = has[owner]
    return train(place[owner[keep]], bucket[keep], target[has], penalty)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``bad_quality`` and ``bad_toxic``, the scorers' probabilities; columns of those names are replaced.

    NULL and empty texts have no features beyond their shape.
    """
    docs = docs.drop("bad_quality", "bad_toxic")
    names = docs.columns
    place, lang = names.index("text"), names.index("lang") if "lang" in names else None
    sent = docs.sparkSession.sparkContext.broadcast(model.weights)  # two times BUCKETS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = sent.value
        for batch in slices(batches):
            texts = [(t or "").encode("utf-8") for t in batch.column(place).to_pylist()]
            english = np.array([x == "en" for x in batch.column(lang).to_pylist()], bool) if lang is not None else np.zeros(len(texts), bool)
            for a, b in chunks(texts):
                found = shapes(texts[a:b], english[a:b])
                out = []
                for task in TASKS:
                    w, bias = weights[task]
                    margin = np.bincount(found.owner, w[found.bucket], b - a) + bias
                    out.append(pa.array(np.round(1 / (1 + np.exp(-np.clip(margin, -40, 40))), 6)))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, *out], names=[*names, "bad_quality", "bad_toxic"])

    schema = StructType([*docs.schema, StructField("bad_quality", DoubleType()), StructField("bad_toxic", DoubleType())])
    return docs.mapInArrow(run, schema)


def judgements(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Per row of ``docs``: doc_id, bad_quality, bad_toxic, rejected (either reaches ``threshold``).

    Rows that repeat a doc_id, or have none, are judged by their own text; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", *(["lang"] if "lang" in docs.columns else []))
    out = scored(rows, fit(docs, labels))
    return out.select("doc_id", "bad_quality", "bad_toxic", (F.greatest("bad_quality", "bad_toxic") >= threshold).alias("rejected"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that are not rejected, as they are."""
    out = scored(docs, fit(docs, labels)).where(F.greatest("bad_quality", "bad_toxic") < threshold)
    return out.select(*(F.col(f"`{c}`") for c in docs.columns if c not in ("bad_quality", "bad_toxic")))
