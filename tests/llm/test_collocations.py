import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from millwright.llm import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, best=2000, longest=5):
    """rows of (lang, text); the report's rows in order."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang in sorted(f):
        counts = f[lang]
        held = {p: a for p, a in counts.items() if a >= least and len(p) > 1}
        rows = []
        for phrase, a in held.items():
            inside = any(
                b >= a and len(q) > len(phrase) and any(q[i : i + len(phrase)] == phrase for i in range(len(q)))
                for q, b in held.items()
            )
            if inside:
                continue
            cuts = [(1000 * a * n[lang] // (counts[phrase[:k]] * counts[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            rows.append((-score, -a, " ".join(phrase).encode(), counts[phrase[:k]], counts[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:best], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return out


def reported(spark, rows, **more):
    docs = spark.createDataFrame([(i, *row, "x", 5) for i, row in enumerate(rows)], "doc_id long, lang string, text string, code string, a int")
    return sorted(map(tuple, collocations.report(docs, **more).collect()))


def random_rows(seed, n=60):
    draw = random.Random(seed)
    words = ["the", "of", "Ünit", "a", "net", "to\xa0day", "日本", "x"]
    known = ["New York stock exchange news", "of the net", "a a a a a a"]

    def piece():
        return " ".join(draw.choice(known) if draw.random() < 0.3 else draw.choice(words) for _ in range(draw.randint(0, 9)))

    langs = ["en", "fr", None, "", "und"]
    return [(draw.choice(langs), draw.choice([". ", "\n", "\t", "  ", "!?"]).join(piece() for _ in range(4))) for _ in range(n)]


@pytest.mark.parametrize("pointers,split", [(1 << 21, 1 << 20), (50, 30), (7, 0)])
def test_agrees_with_brute_force(spark, monkeypatch, pointers, split):
    monkeypatch.setattr(collocations, "POINTERS", pointers)
    monkeypatch.setattr(collocations, "SPLIT", split)
    rows = random_rows(pointers)
    assert reported(spark, rows, least=5) == brute(rows, 5)


def test_the_best_of_each_language_with_ties(spark, monkeypatch):
    monkeypatch.setattr(collocations, "RANGES", 3)
    rows = random_rows(3, 40)
    assert reported(spark, rows, least=3, best=7) == brute(rows, 3, 7)
    assert reported(spark, rows, least=3, longest=2) == brute(rows, 3, longest=2)
    assert reported(spark, rows, least=3, longest=3) == brute(rows, 3, longest=3)


def test_odd_rows(spark):
    rows = [("en", None), ("en", ""), (None, " \t\n.,"), ("en", "Big data " * 30_000), ("en", "one"), (None, "Big Data big\x00 data")]
    assert reported(spark, rows, least=2) == brute(rows, 2)
    assert reported(spark, rows, least=10**6) == []
    assert reported(spark, rows[:3]) == reported(spark, []) == []


def test_words_that_share_a_hash_are_hashed_anew(spark, monkeypatch):
    first = []
    words = spark.createDataFrame([("en", "a", 5), ("en", "b", 1), ("fr", "a", 5)], "lang string, word string, f long")
    real = collocations.F.xxhash64

    def weak(column):
        first.append(0)
        return real(column) if len(first) > 2 else collocations.F.lit(9).cast("long")

    monkeypatch.setattr(collocations.F, "xxhash64", weak)
    salt, frequent = collocations.hashed(words, 5)
    assert salt == "2" and len({r.code for r in frequent.collect()}) == 2


def test_hash_is_the_same_in_tasks_and_columns(spark):
    words = spark.createDataFrame([("dé", "wört", 5), ("", "1-x", 5)], "lang string, word string, f long")
    salt, frequent = collocations.hashed(words, 1)
    for row in frequent.collect():
        codes = collocations.Codes(salt, row.lang, b"\xff" * (collocations.FILTER_BITS // 8))
        assert codes.of([row.word.encode()]).tolist() == [row.code % 2**64, 0]


def test_quicksort_counts_every_depth():
    draw = random.Random(1)
    words = np.array([[draw.randint(1, 3) for _ in range(400)] for _ in range(4)], np.uint64)
    weight = np.array([draw.randint(1, 3) for _ in range(400)])
    words[3, ::3] = 0
    want = Counter()
    for d in range(1, 5):
        for i in range(400):
            if words[d - 1, i]:
                want[tuple(words[:d, i].tolist())] += int(weight[i])
    got = {tuple(words[:d, p].tolist()): c for p, d, c in collocations.three_way(words, weight, 20, {2, 3, 4})}
    assert got == {p: c for p, c in want.items() if c >= 20 and len(p) > 1}
