import random
from collections import Counter

import numpy as np
import pytest

from millwright.llm import arrays, line_dedup


def brute(rows, percent=80):
    """rows of (id, text); per row (lines, links, removed numbers)."""
    lines = []
    for number, (doc_id, text) in enumerate(rows):
        for line, words in enumerate((text or "").split("\n")):
            words = frozenset(words.encode().lower().split())
            if words:
                lines.append((number, (doc_id is None, doc_id or 0, line), line, words))
    sets = {words for *_, words in lines}
    match = {
        x: {y for y in sets if 100 * len(x & y) >= percent * len(x | y)} for x in sets
    }
    first = {}
    for _, place, _, words in lines:
        first[words] = min(first.get(words, place), place)
    out = [[0, 0, []] for _ in rows]
    for number, place, line, words in lines:
        out[number][0] += 1
        out[number][1] += len(match[words]) - 1
        if min(first[y] for y in match[words]) < place:
            out[number][2].append(line)
    return Counter((rows[n][0], a, b, ",".join(map(str, c))) for n, (a, b, c) in enumerate(out))


def random_rows(seed, n):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["the"] * 10
    lines = [" ".join(draw.choices(words, k=draw.randint(1, 14))) for _ in range(30)]

    def line():
        tokens = draw.choice(lines).split()
        if draw.random() < 0.5:
            tokens[draw.randrange(len(tokens))] = draw.choice(words)
        if draw.random() < 0.3:
            tokens.append(draw.choice(words).upper())
        return " ".join(tokens) if draw.random() < 0.9 else ""

    return [(i, "\n".join(line() for _ in range(draw.randint(0, 6)))) for i in range(n)]


@pytest.mark.parametrize("percent,known", [(80, 1 << 19), (80, 5), (60, 12)])
def test_agrees_with_brute_force(documents, monkeypatch, percent, known):
    monkeypatch.setattr(line_dedup, "PAIRS", 10)
    monkeypatch.setattr(line_dedup.frequent_words, "__defaults__", (known,))
    rows = random_rows(percent + known, 60)
    got = Counter((r.doc_id, r.n_lines, r.n_links, r.removed_lines) for r in line_dedup.report(documents(*rows), percent).collect())
    assert got == brute(rows, percent)


def test_odd_rows(documents):
    rows = [(2, None), (1, ""), (None, "a b c"), (5, "a b c\n \na b c"), (5, "a b c\n \na b c"), (6, "word " * 50_000)]
    got = Counter((r.doc_id, r.n_lines, r.n_links, r.removed_lines) for r in line_dedup.report(documents(*rows)).collect())
    assert got == brute(rows)
    assert line_dedup.report(documents()).count() == 0


def test_texts_without_the_removed_lines(documents):
    text = "one two three four five\nonly here"
    docs = documents((1, text), (2, "one two three four FIVE\nother"), (2, "one two three four FIVE\nother"), (3, None))
    got = sorted((r.doc_id, r.text) for r in line_dedup.without_repeated_lines(docs).collect() if r.doc_id != 3)
    assert got == [(1, text), (2, "other"), (2, "other")]


def test_rarest_words_come_first(spark):
    counts = spark.createDataFrame([(1, 9), (2, 1), (3, 4), (4, 2), (5, 2)], "word long, n long")
    for limit, want in ((10, {4: 1, 5: 2, 3: 3, 1: 4}), (3, {3: 1, 1: 2}), (0, {})):
        words, rarity = line_dedup.frequent_words(counts, limit)
        assert dict(zip(words.tolist(), rarity.tolist())) == want


def like_lines(n):
    """A large group of lines that are nearly all alike, one line longer than the others, and copies."""
    base = [f"b{i}" for i in range(20)]
    rows = [(i, " ".join(base[: i % 20] + [f"x{i}"] + base[i % 20 + 1 :])) for i in range(n)]
    return [*rows, (n, " ".join(f"y{i}" for i in range(3_000))), (n + 1, rows[3][1].upper()), (n + 2, rows[3][1])]


@pytest.mark.parametrize("block,part,words", [(4, 1 << 20, 1 << 20), (7, 5, 30), (1 << 14, 50, 1)])
def test_blocks_and_parts_change_no_result(documents, monkeypatch, block, part, words):
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    monkeypatch.setattr(line_dedup, "PART_WORDS", part)
    monkeypatch.setattr(line_dedup, "WORDS", words)
    monkeypatch.setattr(line_dedup, "GATHERED", part)
    rows = like_lines(40) + random_rows(block, 30)
    got = Counter((r.doc_id, r.n_lines, r.n_links, r.removed_lines) for r in line_dedup.report(documents(*rows)).collect())
    assert got == brute(rows)


def test_a_group_of_like_lines_gives_one_row_a_class(documents, spark):
    rows = like_lines(60)
    _, classes = line_dedup.line_links(documents(*rows))
    assert classes.count() == 61  # two rows repeat the fourth
    assert sum(r.n_links or 0 for r in classes.collect()) > 60 * 10


def test_word_hashes_depend_on_the_bytes_alone():
    words = [b"a", b"a\0", b"a\0\0", b"abcdefgh", b"abcdefghi", b"x" * 64, b"x" * 65, b"y" * 900, "ü".encode()]
    data, begins = arrays.laid_out(words + words[::-1])
    starts, ends = arrays.word_spans(data)
    found = line_dedup.word_hashes(data, starts, ends).tolist()
    assert found[: len(words)] == found[len(words) :][::-1]
    assert len(set(found)) == len(words)


def test_sets_survive_packing():
    size = np.array([3, 1, 2])
    rank = np.array([0, 0, 5, 0, 2, 524_288])
    code = np.array([1 << 63, (1 << 64) - 1, 5, 7 << 40, 2, 524_288], np.uint64)
    sets = line_dedup.Sets(line_dedup.packed(size, rank, code))
    assert sets.size.tolist() == [3, 1, 2]
    assert sets.word.tolist() == [1, 2, 4, 0, 3, 5]
    assert sets.number(code.view(np.int64)).tolist() == [1, 2, 4, 0, 3, 5]


def test_rows_survive_blobs():
    key, a, b = np.array([3, 1, 3]), np.array([-1, 2, 5]), np.array([7, 8, 9], np.uint32)
    keys, found = line_dedup.blobs(key, [a, b])
    assert keys.tolist() == [1, 3]
    assert [c.tolist() for c in line_dedup.columns_of(found, [np.int64, np.uint32])] == [[2, -1, 5], [8, 7, 9]]
    assert line_dedup.blobs(key[:0], [a[:0], b[:0]])[1] == []


def test_long_lines_without_a_match_are_no_candidates(documents, monkeypatch):
    kept, stored = {}, line_dedup.stored

    def keep(df, label):
        kept[label] = stored(df, label)
        return kept[label]

    monkeypatch.setattr(line_dedup, "stored", keep)
    draw = random.Random(5)
    words = [f"w{i}" for i in range(2_000)]
    rows = [(i, " ".join(draw.sample(words, 130 + i % 90))) for i in range(200)]
    got = Counter((r.doc_id, r.n_lines, r.n_links, r.removed_lines) for r in line_dedup.report(documents(*rows)).collect())
    assert got == brute(rows)
    assert kept["line-candidates"].count() < 20


def test_wide_maps_fold_and_never_differ_more_than_their_sets():
    draw = random.Random(8)
    sets = [sorted(draw.sample(range(1, 400), draw.choice([3, 71, 72, 73, 160, 161, 300]))) for _ in range(60)]
    size = np.array([len(s) for s in sets])
    maps = line_dedup.parity_maps(np.concatenate([np.array(s, np.uint64) for s in sets]), np.cumsum(size) - size)
    lanes = line_dedup.lanes_of(size)
    assert {(n, k) for n, k in zip(size.tolist(), lanes.tolist())} >= {(72, 1), (73, 2), (160, 2), (161, 4)}
    for i in range(len(sets)):
        for j in range(i):
            n = min(lanes[i], lanes[j])
            differ = np.bitwise_count(line_dedup.folded(maps[[i]] ^ maps[[j]], n)).sum()
            assert differ <= len(set(sets[i]) ^ set(sets[j]))


def test_coder_knows_all_known_words_and_no_others():
    draw = np.random.default_rng(3)
    close = np.arange(50, dtype=np.uint64)
    known = np.unique(np.concatenate([draw.integers(0, 1 << 64, 300, np.uint64), close, close + (np.uint64(1) << np.uint64(63)), ~close]))
    place = draw.permutation(len(known)) + 1
    words = np.concatenate([known, known + np.uint64(1), known - np.uint64(1), draw.integers(0, 1 << 64, 300, np.uint64)])
    want = dict(zip(known.tolist(), place.tolist()))
    rank, code = line_dedup.Coder(known, place)(words)
    assert rank.tolist() == [want.get(word, 0) for word in words.tolist()]
    assert code.tolist() == [want.get(word, word) for word in words.tolist()]
    assert line_dedup.Coder(known[:0], place[:0])(words)[0].sum() == 0


@pytest.mark.parametrize("counted", [8, 1 << 22])
def test_word_counts_are_whole(spark, monkeypatch, counted):
    monkeypatch.setattr(line_dedup, "COUNTED", counted)
    texts = [f"a b{i % 7} c{i} a\nÜ{i % 3} A" for i in range(60)] + ["", "only"]
    want = Counter(word for text in texts for word in text.encode().lower().split())
    df = spark.createDataFrame([(text.encode(),) for text in texts], "bytes binary").repartition(5)
    assert sorted(r.n for r in line_dedup.word_counts(df).collect()) == sorted(n for n in want.values() if n > 1)


def test_words_of_many_classes_are_cut_into_blocks_known_or_not(documents, monkeypatch):
    monkeypatch.setattr(line_dedup, "BLOCK", 4)
    found, leads = [], line_dedup.frequent_leads
    monkeypatch.setattr(line_dedup, "frequent_leads", lambda heads: found.append(leads(heads)) or found[-1])
    lines = [f"lead z{i} z{j}" for i in range(8) for j in range(i)] + [" ".join(f"z{i}" for i in range(8))] * 40
    rows = list(enumerate(lines))
    for known in (1 << 19, 0):
        monkeypatch.setattr(line_dedup.frequent_words, "__defaults__", (known,))
        got = Counter((r.doc_id, r.n_lines, r.n_links, r.removed_lines) for r in line_dedup.report(documents(*rows)).collect())
        assert got == brute(rows)
    assert found[0][1].tolist() == [7]
    assert len(found[1][1]) > 0
