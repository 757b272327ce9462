"""Phrases whose words stand together more often than their parts explain.

Texts (A-Z in lower case) are cut into pieces at ``. , ; : ! ?`` and at line
feed to carriage return, pieces into words at spaces and tabs. Phrases of 2 to
``LONGEST`` words inside a piece are counted per language, every occurrence,
by sorting pointers to the words where they begin:

1. Words are counted, so that rare ones can end a phrase and the number of
   parts of the sort is known.
2. Every task collapses equal pointers, then routes them by a hash of their
   leading words to parts of bounded size.
3. A part is sorted by a multikey three-way quicksort: pointers are divided
   into less, equal and greater by the word at one depth, and the equal ones go
   on at the next depth. The size of an equal partition is the count of its
   phrase; a partition below the least count is abandoned.

The first routing is by two words to depth two, so the pairs are known; the
second one takes the pointers whose leading pairs are all frequent, routed by
that pair, to the full depth. Leading pairs with more than ``SPLIT`` pointers
would crowd a part: their pointers are cut to each depth and routed by all
their words, so equal ones collapse in the tasks before they meet.

Words are 64-bit hashes of language and word while they are sorted. A hash
that a frequent word shares with any other word of the corpus is found while
words are counted; then all words are hashed with another salt.

A phrase is scored at its weakest cut into two parts, with
``floor(1000 * a * n / (l * r))`` from the counts of phrase, words of the
language, left and right part, in 38-digit decimals.

A null text counts as empty, a null language as ``und``. Repeated rows count
each time. A text or table without words, or without frequent phrases, gives
no rows. Equal scores go by count, then by the phrase's bytes. Further columns
are ignored.
"""

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwright.llm.arrays import mixed
from millwright.llm.common import FILTER_BITS, bit_filter, bounded_batches, in_filter, stored, utf8

LONGEST = 5
#: a phrase needs so many occurrences
LEAST = 100
#: phrases per language in the report
BEST = 2000
#: pointers that a task collapses at a time, and that a part should hold
POINTERS = 1 << 21
#: a leading pair with more pointers is spread over parts by further words
SPLIT = 1 << 20
#: distinct words whose hash a task remembers
KNOWN_WORDS = 500_000
#: ranges in which the best phrases of a language are found before all of them meet
RANGES = 64

_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")
#: codes of no word: a rare word or the end of a piece, and the empty string between two spaces
_END, _NOTHING = 0, 1
_PARTS = "depth int, part long, pointers binary"
_EMPTY = np.zeros(0, np.int64)

Pointers = tuple[np.ndarray, np.ndarray]


def prefix(salt: str, lang: str) -> str:
    """What is hashed before a word; no two of a salt, a language and a word share a string."""
    return f"{salt}:{len(lang)}:{lang}"


class Codes(dict):
    """Words to their hashes; a word that the filter does not hold ends a phrase."""

    def __init__(self, salt: str, lang: str, bits: bytes):
        self.start, self.bits = prefix(salt, lang).encode(), bits
        self[b""], self[b"\n"] = _NOTHING, _END

    def __missing__(self, word: bytes) -> int:
        code = xxhash.xxh64_intdigest(self.start + word, 42)
        slot = code % FILTER_BITS  # as in ``in_filter``, for one word
        code = code if self.bits[slot >> 3] >> (slot & 7) & 1 else _END
        if len(self) < KNOWN_WORDS:
            self[word] = code
        return code

    def of(self, texts: list[bytes]) -> np.ndarray:
        """The words of the texts in order, with an end after each piece."""
        words = b"\n".join([*texts, b""]).translate(_PLAIN).replace(b"\n", b" \n ").split(b" ")
        codes = np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
        return codes[codes != _NOTHING]


def three_way(words: np.ndarray, weight: np.ndarray, least: int, depths: set[int]) -> Iterator[tuple[int, int, int]]:
    """Multikey quicksort of pointers; (pointer, depth, count) of each frequent phrase of a wanted depth.

    ``words[d]`` holds the word at depth d of every pointer, 0 behind its last
    one; a pointer counts as often as its weight says.
    """
    deepest = max(depths)
    left = [(np.arange(len(weight)), 0)] if len(weight) and int(weight.sum()) >= least else []
    while left:
        pointers, depth = left.pop()
        at = words[depth][pointers]
        pivot = at[len(at) // 2]
        sides = [(pointers[at < pivot], depth), (pointers[at > pivot], depth)]
        equal = pointers[at == pivot] if len(sides[0][0]) or len(sides[1][0]) else pointers
        if pivot:  # else these phrases have ended
            count = int(weight[equal].sum())
            if count >= least:
                if depth + 1 in depths:
                    yield int(equal[0]), depth + 1, count
                if depth + 1 < deepest:
                    left.append((equal, depth + 1))
        left.extend((side, d) for side, d in sides if len(side) and int(weight[side].sum()) >= least)


def leading(words: np.ndarray) -> np.ndarray:
    """A hash of the words of each pointer, all depths given."""
    key = np.zeros(words.shape[1], np.uint64)
    for row in words:
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + row)
    return key


def collapsed(words: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pointers in the order of their parts, equal ones as one with a weight."""
    if not words.shape[1]:
        return words, part, _EMPTY
    room = np.uint64(int(part.max()).bit_length())
    order = np.argsort(part.astype(np.uint64) << (np.uint64(64) - room) | leading(words) >> room if room else leading(words))
    words, part = words[:, order], part[order]
    # equal pointers stand together unless their hashes meet others, which only leaves them apart
    new = np.ones(len(part), bool)
    new[1:] = (part[1:] != part[:-1]) | (words[:, 1:] != words[:, :-1]).any(axis=0)
    first = np.flatnonzero(new)
    return words[:, first], part[first], np.diff(np.append(first, len(part)))


def packed(words: np.ndarray, weight: np.ndarray) -> bytes:
    return np.vstack([words, weight.astype(np.uint64)[None]]).tobytes()


def unpacked(blocks: list[bytes], depth: int) -> Pointers:
    found = [np.frombuffer(block, np.uint64).reshape(depth + 1, -1) for block in blocks]
    table = np.concatenate(found, axis=1)
    return table[:depth], table[depth].astype(np.int64)


def _blocks(depth: int, words: np.ndarray, route: np.ndarray, parts: int) -> Iterator[tuple[int, int, bytes]]:
    """Rows (depth, part, pointers) for the shuffle; ``route`` is a hash."""
    part = (route % np.uint64(parts)).astype(np.int64)
    words, part, weight = collapsed(words, part)
    starts = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else _EMPTY
    for a, b in zip(starts, np.append(starts[1:], len(part))):
        yield depth, int(part[a]), packed(words[:, a:b], weight[a:b])


def pairs(codes: np.ndarray) -> np.ndarray:
    """Pointers to depth two."""
    at = np.flatnonzero((codes[:-1] != _END) & (codes[1:] != _END))
    return np.vstack([codes[at], codes[at + 1]])


def runs(codes: np.ndarray, frequent: np.ndarray, depth: int) -> np.ndarray:
    """Pointers to three words and more, as far as all pairs are frequent."""
    two = np.vstack([codes[:-1], codes[1:]])
    linked = np.zeros(len(codes) + depth, bool)
    linked[: len(codes) - 1] = (two != _END).all(axis=0) & in_filter(frequent, leading(two).view(np.int64))
    at = np.flatnonzero(linked[:-1] & linked[1:])
    padded = np.concatenate([codes, np.zeros(depth, np.uint64)])
    words = np.zeros((depth, len(at)), np.uint64)
    words[0], goes_on = padded[at], np.ones(len(at), bool)
    for d in range(1, depth):
        goes_on &= linked[at + d - 1]
        words[d] = np.where(goes_on, padded[at + d], _END)
    return words


def _texts(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), utf8(text_col).alias("bytes"))


def _by_lang(batch: pa.RecordBatch) -> dict[str, list[bytes]]:
    texts: dict[str, list[bytes]] = {}
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        texts.setdefault(lang, []).append(text)
    return texts


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, word, f), combined per batch before the shuffle."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, found in _by_lang(batch).items():
                counts = Counter(b"\n".join(found).translate(_PLAIN).replace(b"\n", b" ").split(b" "))
                counts.pop(b"", None)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(counts)),
                        pa.array(list(counts), pa.binary()).cast(pa.string()),
                        pa.array(list(counts.values()), pa.int64()),
                    ],
                    ["lang", "word", "f"],
                )

    return texts.mapInArrow(work, "lang string, word string, f long").groupBy("lang", "word").agg(F.sum("f").alias("f"))


def hashed(words: DataFrame, least: int) -> tuple[str, DataFrame]:
    """A salt that gives every frequent word a hash of its own, and (lang, word, f, code) of those words."""
    attempt = 0
    while True:
        salt = str(attempt)
        start = F.concat(F.lit(f"{salt}:"), F.char_length("lang").cast("string"), F.lit(":"), "lang", "word")
        coded = words.withColumn("code", F.xxhash64(start))
        frequent = stored(coded.filter(F.col("f") >= least), "frequent-words")
        # only words that the frequent ones' filter lets through could be taken for one of them
        shared = coded.join(frequent.select("code"), "code", "left_semi").groupBy("code").count().filter("count > 1")
        if shared.isEmpty() and frequent.filter(F.col("code").isin(_END, _NOTHING)).isEmpty():
            return salt, frequent
        attempt += 1


def _sorted(texts: DataFrame, salt: str, known: np.ndarray, parts: int, least: int, depth: int, pair_bits: tuple | None) -> DataFrame:
    """(codes, a) of the frequent phrases: of two words without ``pair_bits``, else of three to ``depth``."""
    held = [known.tobytes(), *(bits.tobytes() for bits in pair_bits or ())]
    shared = texts.sparkSession.sparkContext.broadcast(held)
    low = 3 if pair_bits else 2

    def route(codes: np.ndarray, filters: list[np.ndarray]) -> Iterator[tuple[int, int, bytes]]:
        if not filters:
            words = pairs(codes)
            yield from _blocks(2, words, leading(words), parts)
            return
        words = runs(codes, filters[0], depth)
        pair = leading(words[:2])
        crowded = in_filter(filters[1], pair.view(np.int64))
        yield from _blocks(depth, words[:, ~crowded], pair[~crowded], parts)
        words = words[:, crowded]
        for d in range(low, depth + 1):
            cut = words[:d, words[d - 1] != _END]
            # a negative depth marks pointers that count at this depth alone
            yield from _blocks(-d, cut, leading(cut), parts)

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, *filters = shared.value
        filters = [np.frombuffer(f, np.uint8) for f in filters]
        tables: dict[str, Codes] = {}
        waiting, n = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            for row in route(np.concatenate(waiting), filters):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[0]], pa.int32()), pa.array([row[1]], pa.int64()), pa.array([row[2]], pa.binary())],
                    ["depth", "part", "pointers"],
                )

        for batch in batches:
            for lang, found in _by_lang(batch).items():
                codes = tables.setdefault(lang, Codes(salt, lang, bits)).of(found)
                # texts longer than the limit are cut where a piece ends or a rare word stands
                ends = np.flatnonzero(codes == _END)
                while len(codes):
                    room = POINTERS - n
                    stop = len(codes)
                    if stop > room:
                        before = ends[np.searchsorted(ends, room, "right") - 1] if len(ends) and ends[0] <= room else None
                        stop = int(before) + 1 if before is not None else 0
                        if not stop and not n:  # not even one whole piece fits
                            stop = int(ends[0]) + 1 if len(ends) else len(codes)
                    waiting.append(codes[:stop])
                    n, codes, ends = n + stop, codes[stop:], ends[ends >= stop] - stop
                    if n >= POINTERS or len(codes):
                        yield from flush()
                        waiting, n = [], 0
        if waiting:
            yield from flush()

    def sort(key: tuple, table: pa.Table) -> pa.Table:
        depth = key[0].as_py()
        words, weight = unpacked(table.column("pointers").to_pylist(), abs(depth))
        depths = {-depth} if depth < 0 else set(range(low, depth + 1))
        phrases, counts = [], []
        for pointer, d, count in three_way(words, weight, least, depths):
            phrases.append(words[:d, pointer].view(np.int64).tolist())
            counts.append(count)
        return pa.table({"codes": pa.array(phrases, pa.list_(pa.int64())), "a": pa.array(counts, pa.int64())})

    blocks = texts.mapInArrow(collapse, _PARTS)
    return blocks.groupBy("depth", "part").applyInArrow(sort, "codes array<long>, a long")


def pair_key(codes: Column) -> Column:
    """``leading`` of a pair, as a column."""

    def key(batches):
        for batch in batches:
            two = np.array([list(c) for c in batch], np.int64).reshape(-1, 2).view(np.uint64).T
            yield pd.Series(leading(np.ascontiguousarray(two)).view(np.int64))

    key.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(key, "long")(codes)


def phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(phrases, words, totals): (codes, a) of all frequent phrases, (lang, word, f, code) of frequent words, (lang, n)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = _texts(docs, lang_col, text_col)
    counts = stored(word_counts(texts), "word-counts")
    totals = stored(counts.groupBy("lang").agg(F.sum("f").alias("n")), "language-totals")
    words_in_all = totals.agg(F.sum("n")).first()[0] or 0
    salt, frequent = hashed(counts, least)
    known = bit_filter(frequent, "code")

    parts = 1 + words_in_all // POINTERS
    two = stored(_sorted(texts, salt, known, parts, least, 2, None), "frequent-pairs")
    if longest == 2:
        return two, frequent, totals
    keyed = stored(two.select(pair_key(F.col("codes")).alias("pair"), "a"), "pair-keys")
    bits = bit_filter(keyed, "pair"), bit_filter(keyed.filter(F.col("a") > SPLIT), "pair")
    parts = 1 + (two.agg(F.sum("a")).first()[0] or 0) // POINTERS
    more = stored(_sorted(texts, salt, known, parts, least, longest, bits), "frequent-phrases")
    return two.unionByName(more), frequent, totals


def scored(phrases: DataFrame, frequent: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, codes, a, l, r, n, score) at each phrase's weakest cut."""
    counts = phrases.select("codes", F.col("a").alias("f")).unionByName(frequent.select(F.array("code").alias("codes"), "f"))
    langs = frequent.select(F.col("code").alias("head"), "lang").join(totals, "lang")
    cuts = phrases.select("codes", "a", F.explode(F.sequence(F.lit(1), F.size("codes") - 1)).alias("k")).select(
        "codes", "a", "k",
        F.slice("codes", F.lit(1), F.col("k")).alias("first"),
        F.slice("codes", F.col("k") + 1, F.size("codes") - F.col("k")).alias("rest"),
    )
    split = (
        cuts.join(counts.select(F.col("codes").alias("first"), F.col("f").alias("l")), "first")
        .join(counts.select(F.col("codes").alias("rest"), F.col("f").alias("r")), "rest")
        .withColumn("head", F.element_at("codes", 1))
        .join(langs, "head")
    )
    whole = {c: f"cast({c} as decimal(19,0))" for c in ("a", "n", "l", "r")}
    score = F.expr(f"(({whole['a']} * {whole['n']}) * 1000) div ({whole['l']} * {whole['r']})")
    weakest = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    return (
        split.groupBy("lang", "codes", "a", "n")
        .agg(weakest.alias("cut"))
        .select("lang", "codes", "a", "cut.l", "cut.r", "n", "cut.score")
    )


def outermost(found: DataFrame) -> DataFrame:
    """Without the phrases that a longer one of equal count holds.

    One word more is enough to look at: the counts of the phrases between two
    nested ones lie between theirs.
    """
    longer = found.filter(F.size("codes") > 2).select(
        F.explode(
            F.array(F.slice("codes", F.lit(1), F.size("codes") - 1), F.slice("codes", F.lit(2), F.size("codes") - 1))
        ).alias("codes"),
        "a",
    )
    return found.join(longer.distinct(), ["codes", "a"], "left_anti")


def report(docs: DataFrame, least: int = LEAST, best: int = BEST, longest: int = LONGEST, **columns) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    found, frequent, totals = phrases(docs, least, longest, **columns)
    kept = outermost(scored(found, frequent, totals))
    # ties at the end stay in until the phrases' words are known
    by_count = [F.desc("score"), F.desc("a")]
    ranges = F.pmod(F.xxhash64("codes"), F.lit(RANGES))
    for group in (["lang", "range"], ["lang"]):
        place = F.rank().over(Window.partitionBy(*group).orderBy(*by_count))
        kept = kept.withColumn("range", ranges).withColumn("place", place).filter(F.col("place") <= best)
    kept = stored(kept.drop("range", "place"), "best-phrases")
    words = (
        kept.select("codes", F.posexplode("codes").alias("at", "code"))
        .join(frequent.select("code", "word"), "code")
        .groupBy("codes")
        .agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words"))
    )
    named = kept.join(words, "codes").withColumn("phrase", F.array_join("words.word", " "))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*by_count, "phrase"))
    return (
        named.withColumn("rank", rank.cast("long"))
        .filter(F.col("rank") <= best)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
