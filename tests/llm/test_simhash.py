import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from millwright.llm import simhash
from millwright.llm.components import components


def plain(text):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[a : a + 3]) for a in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(codes, distance=3):
    """Smallest index reachable, by plain search."""
    codes = np.array(codes, np.uint64)
    label = np.arange(len(codes))
    near = [np.flatnonzero(np.bitwise_count(codes ^ c) <= distance) for c in codes]
    changed = True
    while changed:
        changed = False
        for i, n in enumerate(near):
            low = label[n].min()
            if low < label[i]:
                label[i], changed = low, True
    return label


def test_fingerprint_matches_the_engine_hash(spark):
    for text in ("", "one", "One two", "a b c", "a b c a b c", "x\ty\x0bz  w é", "w " * 3000):
        assert simhash.fingerprint(text.encode()) == plain(text)
    got = spark.sql("select xxhash64('a b c') as h").first().h & (1 << 64) - 1
    assert simhash.fingerprint(b"A b  c") == got


def test_gray_rank():
    ranks = np.arange(1000, dtype=np.uint64)
    assert (simhash.gray_rank(ranks ^ (ranks >> np.uint64(1))) == ranks).all()


@pytest.mark.parametrize("size", [1, 2, 9, 70, 700])
def test_index_finds_every_close_pair(size):
    draw = np.random.default_rng(size)
    codes = draw.integers(0, 1 << 63, size, dtype=np.uint64)
    near = codes ^ (np.uint64(1) << draw.integers(0, 64, size, dtype=np.uint64))
    codes = np.unique(np.concatenate([codes, near, near ^ np.uint64(5)]))
    codes = codes[np.argsort(simhash.gray_rank(codes))]
    found = {(a, b) for x, y in simhash.close_pairs(codes, 3) for a, b in zip(x.tolist(), y.tolist())}
    want = {(i, j) for i in range(len(codes)) for j in range(i + 1, len(codes)) if int(codes[i] ^ codes[j]).bit_count() <= 3}
    assert found == want


@pytest.mark.parametrize("limit", [8192, 35])
def test_components_agree_with_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(simhash, "NODE_CODES", limit)
    draw = np.random.default_rng(7)
    codes = draw.integers(0, 1 << 63, 60, dtype=np.uint64)
    flips = [codes ^ (np.uint64(1) << draw.integers(0, 64, 60, dtype=np.uint64)) for _ in range(3)]
    chain = [codes[0]]
    for bit in range(40):
        chain.append(chain[-1] ^ np.uint64(1 << bit))
    codes = np.concatenate([codes, *flips, chain, codes[:5]])
    rows = spark.createDataFrame([(i, int(c)) for i, c in enumerate(codes.view(np.int64))], "doc_id long, code long")
    got = {r.doc_id: r.component_id for r in simhash.with_component(rows).collect()}
    assert got == dict(enumerate(classes(codes).tolist()))


def test_report_on_odd_rows(spark, documents):
    rows = simhash.report(documents((4, None), (3, ""), (7, "a b c"), (7, "a b c"), (None, "a b c"), (9, "some other text")))
    got = sorted((r.doc_id or 0, r.fingerprint, r.component_id) for r in rows.collect())
    code = format(plain("a b c"), "016x")
    assert [g for g in got if g[0] in (3, 4)] == [(3, "0" * 16, 3), (4, "0" * 16, 3)]
    assert [g for g in got if g[0] in (0, 7)] == [(0, code, 7), (7, code, 7), (7, code, 7)]
    assert simhash.report(documents()).count() == 0


def test_one_row_of_each_group_stays(documents):
    docs = documents((2, "a b c"), (1, "a b c"), (1, "a b c"), (None, "a b c"), (5, None), (6, ""), (8, "quite another one"))
    kept = simhash.first_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 5, 8]


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 140)] + [(1, n) for n in range(2, 60)] + [(500, 500), (None, 3)]
    links = spark.createDataFrame(path, "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {**dict.fromkeys(range(100, 141), 100), **dict.fromkeys(range(1, 60), 1)}
    assert components(links.filter(F.lit(False))).count() == 0
