"""Small documents that hold the hard cases: nulls, empty and long texts, ties, repeats, odd white space."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n))


def documents(seed: int = 1, copies: int = 12) -> list[tuple]:
    rng = random.Random(seed)
    base = [words(rng, rng.randint(30, 260)) for _ in range(12)]
    passage = words(rng, 90)
    texts = list(base)
    for k in range(copies):  # near copies of one text, with the odd word changed
        w = base[0].split()
        for _ in range(k % 4):
            w[rng.randrange(len(w))] = "changed" + str(k)
        texts.append(" ".join(w))
    texts += [base[1], base[1].upper(), base[2] + "\n\n" + passage, passage + " " + words(rng, 50), "x" + passage + "y " + words(rng, 20)]
    texts += ["", "   ", "one", "one two three", "One  two\tthree", "ab" * 700, "é" * 500, "  two  spaces  \n\n  x ", words(rng, 4000), "<|endoftext|> a  b 漢字 😀"]
    texts += [passage[:-1] + "é" + passage, "so " * 300]
    rows = [(i * 3 % 101 + 1000 * (i // 101), t, "en", "s", len(t)) for i, t in enumerate(texts)]
    return [*rows, (500, None, None, None, None), (None, base[3], "en", None, 1), (7000, base[4], "de", "s", None), (7000, base[4], "de", "s", None)]


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA).repartition(5)
