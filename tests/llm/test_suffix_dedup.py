import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from millwright.llm import arrays, suffix_dedup


def brute(texts, threshold):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + threshold] for d in data for i in range(len(d) - threshold + 1))
    out = []
    for d in data:
        cover = np.zeros(len(d) + 1, int)
        for i in range(len(d) - threshold + 1):
            if seen[d[i : i + threshold]] > 1:
                cover[i] += 1
                cover[i + threshold] -= 1
        gone = np.cumsum(cover)[:-1] > 0
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def texts(seed):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdeé ") for _ in range(draw.randint(1, 9)))
    passages = ["".join(word() for _ in range(12)) for _ in range(5)]
    out = []
    for _ in range(40):
        parts = [draw.choice(passages)[draw.randint(0, 9) :] if draw.random() < 0.4 else word() for _ in range(draw.randint(0, 12))]
        out.append(draw.choice(["", " "]).join(parts))
    return out + out[:4] + [None, "", "ab" * 60, "a" * 90, "a" * 20, "a" * 19, "xy" * 20 + "a" * 30]


@pytest.mark.parametrize("threshold,runs,part", [(20, 4096, 1 << 20), (20, 2, 1 << 20), (33, 4096, 100), (7, 3, 64)])
def test_agrees_with_brute_force(documents, monkeypatch, threshold, runs, part):
    monkeypatch.setattr(suffix_dedup, "RANK_RUNS", runs)
    monkeypatch.setattr(arrays, "PART_BYTES", part)
    rows = texts(threshold + runs)
    want = brute(rows, threshold)
    got = suffix_dedup.report(documents(*enumerate(rows)), threshold).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id], rows[r.doc_id]


def test_repeated_rows_null_ids_and_empty_tables(documents):
    text = "".join(random.Random(1).choice("abcdefgh") for _ in range(500))
    got = sorted((r.doc_id or 0, r.n_removed) for r in suffix_dedup.report(documents((1, text), (1, text), (None, text[:399]))).collect())
    assert got == [(0, 0), (1, 500), (1, 500)]
    assert suffix_dedup.report(documents()).count() == 0


def test_the_smallest_of_each_window():
    draw = np.random.default_rng(2)
    values = draw.integers(0, 9, 200).astype(np.uint32)
    for width in (1, 2, 5, 8, 31):
        place = suffix_dedup._smallest(values, width)
        for i in range(200 - width + 1):
            assert place[i] == i + int(np.argmin(values[i : i + width]))
