"""Near-duplicate lines by an exact set-similarity join.

A line is the set of its words (A-Z in lower case, cut at ASCII white space).
Lines of equal sets form a class. Two classes match if their sets have a
Jaccard similarity of at least ``percent`` hundredths. A line is removed if a
line that stands earlier, by document id and line number, is of its class or
of a matching one.

Words are ordered by rarity, the rarest first; so matching sets share a word
in their first few (prefix filter). The smaller of two sets needs an even
shorter prefix. A shared word's places bound the overlap (positional filter),
the sizes must fit (length filter), and so must the words' parities in a
map of 64 bits or, for larger sets, up to 256, whose difference never exceeds
that of the sets; a wider map folds to a narrower one. What remains is
verified on the whole sets, and counts under the first word that both share,
so under one word only; sets that agree in the word before go on at once.

A class goes to the parts in which the words of its prefix fall, first without
its set; those that pass the filters with another class there come again with
it. A part gives one row per class: how many links it found, and the earliest
class among them; pairs never leave it. The classes of a frequent word are cut
into blocks, and every two blocks meet in a part of their own, so no task
holds all of them.

The most frequent words are ordered by how often they occur, in a table of
bounded size; all others are rarer than those, and any fixed order
will do among them. Words and classes are told apart by 64-bit hashes.

Nulls, empty texts and lines without words have nothing to match and nothing
is removed from them. Every row is a document, repeated rows and ids too;
rows of equal id stand at the same place, so neither removes a line of the
other that has the same number. A null id comes last. An empty table gives an
empty result; further columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwright.llm import arrays
from millwright.llm.common import bit_filter, bounded_batches, in_filter, stored, utf8

PERCENT = 80
#: frequent words whose counts every task knows
KNOWN_WORDS = 1 << 19
#: pairs compared at a time
PAIRS = 1 << 18
#: words of sets compared at a time
WORDS = 1 << 20
#: words of prefixes that one part should take
PART_WORDS = 40_000
#: classes that one block of a frequent word should take
BLOCK = 16_384
#: words of prefixes that a task gathers before it passes them on
GATHERED = 1 << 19
#: words counted before they are passed on
COUNTED = 1 << 22
#: bytes of a word that are hashed eight at a time
SHORT = 64
#: classes a task remembers to have described
DESCRIBED = 500_000

#: sets of more words than the first have parity maps of 128 bits, of more than the second, 256
WIDE = (72, 160)

LINES = "row long, {id}, line int, class long, size int, places binary, often array<long>, words binary"


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, the same wherever it stands; no two words of one length up to eight bytes share one."""
    size = ends - starts
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, 8)
    found = arrays.mixed(size.astype(np.uint64) + np.uint64(1))
    some = np.flatnonzero(size <= SHORT)
    for at in range(0, SHORT, 8):
        some = some[size[some] > at]
        if not len(some):
            break
        run = windows[starts[some] + at].view(np.uint64).ravel()
        spare = np.maximum(8 * (at + 8 - size[some]), 0).astype(np.uint64)
        found[some] = arrays.mixed(found[some] ^ (run << spare >> spare)) + np.uint64(1)
    long = np.flatnonzero(size > SHORT)
    if len(long):
        length = size[long]
        held = data[np.repeat(starts[long], length) + within(length)]
        stops = np.cumsum(length)
        found[long] = arrays.span_hashes(held, stops - length, stops)
    return found


def word_sets(texts: list[bytes]) -> dict[str, np.ndarray]:
    """Lines with words: text and line number, and their distinct words as (line, hash) in order."""
    data, begins = arrays.laid_out([text.lower() for text in texts])
    starts, ends = arrays.word_spans(data)
    line_starts = np.concatenate([[0], np.flatnonzero(data == 10)[:-1] + 1])
    line = np.searchsorted(line_starts, starts, "right") - 1
    word = word_hashes(data, starts, ends)
    # one key for line and the leading bits of the word; where that does not tell words apart, both in full
    spare = np.uint64(max(1, len(line_starts).bit_length()))
    key = line.astype(np.uint64) << (np.uint64(64) - spare) | word >> spare
    order = np.argsort(key)
    key = key[order]
    same = key[1:] == key[:-1]
    if (word[order][1:][same] != word[order][:-1][same]).any():
        order = np.lexsort((word, line))
    line, word = line[order], word[order]
    new = np.ones(len(line), bool)
    new[1:] = (line[1:] != line[:-1]) | (word[1:] != word[:-1])
    line, word = line[new], word[new]
    head = np.ones(len(line), bool)
    head[1:] = line[1:] != line[:-1]
    first = np.flatnonzero(head)
    used = line[first]
    text = np.searchsorted(begins, line_starts[used], "right") - 1
    number = used - np.searchsorted(line_starts, begins[text], "left")
    size = np.diff(np.concatenate([first, [len(line)]]))
    total = np.add.reduceat(arrays.mixed(word + np.uint64(1)), first) if len(first) else np.zeros(0, np.uint64)
    return {
        "text": text, "number": number, "first": first, "size": size,
        "class": arrays.mixed(total + size.astype(np.uint64)), "word": word,
    }


def _signed(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values).astype(np.uint64).view(np.int64)


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys in order, and the sum of each one's values."""
    order = np.argsort(keys)
    keys, values = keys[order], values[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[heads], np.add.reduceat(values, heads) if len(heads) else values


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n): how often each word occurs that occurs more than once.

    A task sends the words of one range of hashes as one blob, as steps from
    word to word. There are as many ranges as tasks that read texts.
    """
    parts = max(1, texts.rdd.getNumPartitions())
    borders = np.array([(at << 64) // parts for at in range(1, parts)], np.uint64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        waiting: list[tuple[np.ndarray, np.ndarray]] = []

        def count() -> None:
            words = np.sort(np.concatenate(held))
            heads = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]])) if len(words) else np.zeros(0, np.int64)
            waiting.append((words[heads], np.diff(np.append(heads, len(words)))))
            held.clear()

        def counted() -> pa.RecordBatch:
            word, n = summed(*(np.concatenate(c) for c in zip(*waiting)))
            waiting.clear()
            part = np.searchsorted(borders, word, "right")
            step = np.diff(word, prepend=np.uint64(0))
            new = np.diff(part, prepend=-1) != 0
            step[new] = word[new]
            key, rows = blobs(part, [step, n.astype(np.int64)])
            return pa.RecordBatch.from_arrays([pa.array(key, pa.int32()), pa.array(rows, pa.binary())], ["part", "rows"])

        for batch in batches:
            for part in arrays.parts(batch.column(0).to_pylist()):
                data, _ = arrays.laid_out([text.lower() for text in part])
                held.append(word_hashes(data, *arrays.word_spans(data)))
                if sum(map(len, held)) > COUNTED // 4:
                    count()
                    if sum(len(word) for word, _ in waiting) > COUNTED:
                        yield counted()
        if held:
            count()
        if waiting:
            yield counted()

    def total(part: pa.Table) -> pa.Table:
        found = [columns_of([rows], [np.uint64, np.int64]) for rows in part.column("rows").to_pylist()]
        word, n = summed(np.concatenate([np.cumsum(step, dtype=np.uint64) for step, _ in found]), np.concatenate([n for _, n in found]))
        return pa.table({"word": pa.array(_signed(word[n > 1])), "n": pa.array(n[n > 1])})

    return texts.mapInArrow(work, "part int, rows binary").groupBy("part").applyInArrow(total, "word long, n long")


def frequent_words(counts: DataFrame, limit: int = KNOWN_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """At most ``limit`` most frequent words as (hash in order, place by rarity from 1)."""
    bands = counts.groupBy("n").agg(F.count("*").alias("words")).filter("n > 1")
    # as many rows as there are different counts; only the running sum from the top matters
    held, least = 0, None
    for row in bands.orderBy(F.desc("n")).toLocalIterator():
        if held + row["words"] > limit:
            break
        held, least = held + row["words"], row["n"]
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    kept = counts.filter(F.col("n") >= least).toPandas()
    word, n = kept["word"].to_numpy(np.int64).view(np.uint64), kept["n"].to_numpy(np.int64)
    rarity = np.empty(len(word), np.int64)
    rarity[np.lexsort((word, n))] = np.arange(1, len(word) + 1)
    order = np.argsort(word)
    return word[order], rarity[order]


class Coder:
    """Gives words their places by rarity, from a table by the leading bits of the hashes."""

    def __init__(self, known: np.ndarray, place: np.ndarray):
        bits = len(known).bit_length() + 1
        self.spare = np.uint64(64 - bits)
        # no hash is left without a word to be compared with
        self.known, self.place = np.append(known, np.uint64(0)), np.append(place, 0).astype(np.int32)
        self.start = np.searchsorted(known >> self.spare, np.arange(1 << bits).astype(np.uint64)).astype(np.int32)
        self.stop = len(known)

    def __call__(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each word's place by rarity, 0 for a rare one, and its code: the place, or the hash of a rare word."""
        spot = self.start[words >> self.spare]
        here = self.known[spot]
        behind = np.flatnonzero((here < words) & (spot < self.stop))
        while len(behind):
            spot[behind] += 1
            here[behind] = self.known[spot[behind]]
            behind = behind[(here[behind] < words[behind]) & (spot[behind] < self.stop)]
        rank = np.where((here == words) & (spot < self.stop), self.place[spot], 0).astype(np.int64)
        return rank, np.where(rank > 0, rank.astype(np.uint64), words)


def within(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each count, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def packed(size: np.ndarray, rank: np.ndarray, code: np.ndarray) -> pa.BinaryArray:
    """Sets as bytes: how many rare words, their hashes, then three bytes for each other word.

    The words of the sets follow each other, each set's in order of rarity.
    """
    rare = rank == 0
    owner = np.repeat(np.arange(len(size)), size)
    width = np.where(rare, 8, 3)
    n_rare = np.bincount(owner[rare], minlength=len(size))
    begin = np.concatenate([[0], np.cumsum(4 + 8 * n_rare + 3 * (size - n_rare))])
    spot = np.cumsum(width) - width + 4 * (owner + 1)
    data = np.zeros(begin[-1], np.uint8)
    data[begin[:-1, None] + np.arange(4)] = n_rare.astype("<u4").view(np.uint8).reshape(-1, 4)
    data[spot[rare][:, None] + np.arange(8)] = np.ascontiguousarray(code[rare]).view(np.uint8).reshape(-1, 8)
    data[spot[~rare][:, None] + np.arange(3)] = rank[~rare].astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3]
    buffers = [None, pa.py_buffer(begin.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())]
    return pa.Array.from_buffers(pa.binary(), len(size), buffers)


def unpacked(column: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sets: how many words each has, how many of them are rare, and the codes of all."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)
    start = offsets[:-1]
    n_rare = data[start[:, None] + np.arange(4)].view("<u4").ravel().astype(np.int64)
    n_often = (np.diff(offsets) - 4 - 8 * n_rare) // 3
    size = n_rare + n_often
    begin = np.cumsum(size) - size
    code = np.empty(int(size.sum()), np.uint64)
    at = np.repeat(start + 4, n_rare) + 8 * within(n_rare)
    code[np.repeat(begin, n_rare) + within(n_rare)] = data[at[:, None] + np.arange(8)].view(np.uint64).ravel()
    at = np.repeat(start + 4 + 8 * n_rare, n_often) + 3 * within(n_often)
    low, mid, high = (data[at + n].astype(np.uint64) for n in range(3))
    code[np.repeat(begin + n_rare, n_often) + within(n_often)] = low | mid << np.uint64(8) | high << np.uint64(16)
    return size, n_rare, code


def parity_maps(code: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For sets of words, each from its first on: four times 64 bits, each word turning one bit over.

    The maps of small sets are folded, all in the first 64 bits.
    """
    spot = arrays.mixed(code + np.uint64(1))
    bit = np.uint64(1) << (spot & np.uint64(63))
    maps = np.zeros((len(first), 4), np.uint64)
    if len(first):
        maps[:, 0] = np.bitwise_xor.reduceat(bit, first)
        size = np.diff(np.append(first, len(code)))
        large = np.flatnonzero(lanes_of(size) > 1)
        if len(large):
            size = size[large]
            words = np.repeat(first[large], size) + within(size)
            bit, lane = bit[words], spot[words] >> np.uint64(6) & np.uint64(3)
            for n in range(4):
                maps[large, n] = np.bitwise_xor.reduceat(np.where(lane == n, bit, np.uint64(0)), np.cumsum(size) - size)
    return maps


def lanes_of(size: np.ndarray) -> np.ndarray:
    """How many times 64 bits the parity maps of sets have."""
    return np.where(size > WIDE[1], 4, np.where(size > WIDE[0], 2, 1))


def folded(maps: np.ndarray, lanes: int) -> np.ndarray:
    """Wide maps as narrower ones; words that differ in no bit there may differ in the wide ones, not the other way."""
    return np.bitwise_xor.reduce(maps.reshape(len(maps), maps.shape[1] // lanes, lanes), axis=1)


class Sets:
    """Packed sets, unpacked together: numbers stand for words, in order of rarity."""

    def __init__(self, column: pa.BinaryArray):
        self.size, n_rare, code = unpacked(column)
        self.begin = np.cumsum(self.size) - self.size
        rare = within(self.size) < np.repeat(n_rare, self.size)
        self.rare, low = np.unique(code[rare], return_inverse=True)
        self.often, high = np.unique(code[~rare].astype(np.int64), return_inverse=True)
        #: how many different words there are
        self.n = len(self.rare) + len(self.often)
        self.word = np.empty(len(code), np.int64)
        self.word[rare] = low
        self.word[~rare] = high + len(self.rare)

    def number(self, code: np.ndarray) -> np.ndarray:
        """The numbers of words given by their codes."""
        code = code.view(np.uint64)
        often = code <= KNOWN_WORDS
        return np.where(often, len(self.rare) + np.searchsorted(self.often, code.astype(np.int64)), np.searchsorted(self.rare, code))

    def parity(self) -> np.ndarray:
        """The parity maps of all sets."""
        codes = np.concatenate([self.rare, self.often.astype(np.uint64)])
        return parity_maps(codes[self.word], self.begin)

    def keys(self, sets: np.ndarray) -> np.ndarray:
        """The words of some sets, each behind its place in the list; ascending."""
        size = self.size[sets]
        return np.repeat(np.arange(len(sets)) * self.n, size) + self.word[np.repeat(self.begin[sets], size) + within(size)]

    def shared(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For pairs of sets: how many words they share, and the first of those."""
        x, y = self.keys(a), self.keys(b)
        spot = np.searchsorted(y, x)
        spot[spot == len(y)] = 0
        hit = y[spot] == x
        starts = np.cumsum(self.size[a]) - self.size[a]
        first = np.minimum.reduceat(np.where(hit, x % self.n, self.n), starts)
        return np.add.reduceat(hit.astype(np.int64), starts), first


def by_rarity(size: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The order of each set's words by rank; equal ranks stay in the order of their hashes."""
    key = np.repeat(np.arange(len(size)), size) * (KNOWN_WORDS * 2) + rank
    bits = len(key).bit_length()
    if len(size).bit_length() + (KNOWN_WORDS * 2).bit_length() + bits > 63:
        return np.argsort(key, kind="stable")
    return np.sort(key << bits | np.arange(len(key))) & ((1 << bits) - 1)


def runs(weights: np.ndarray, limit: int) -> Iterator[slice]:
    """The items in runs of at most ``limit`` total weight; a heavier one comes alone."""
    ends = np.cumsum(weights)
    at = 0
    while at < len(ends):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, "right")))
        yield slice(at, stop)
        at = stop


def _described(
    texts: DataFrame, known_words: tuple[np.ndarray, np.ndarray], often: int, bits: np.ndarray, percent: int, id_type: str
) -> DataFrame:
    """One row per line with words, and one with a null line per text.

    The set, in order of rarity, and the places of its prefix come with the
    first line of a class in a task; words that occur once only are left out
    of the prefix. Its words from place ``often`` by rarity on are named, too.
    """
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast((*(a.tobytes() for a in known_words), bits.tobytes()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rarity, twice = (np.frombuffer(b, t) for b, t in zip(shared.value, (np.uint64, np.int64, np.uint8)))
        coded = Coder(known, rarity)
        described: set[int] = set()
        for batch in batches:
            rows, texts = batch.column(0).to_numpy(), batch.column(2).to_pylist()
            at = 0
            for part in arrays.parts(texts):
                found = word_sets(part)
                classes = _signed(found["class"])
                names, heads = np.unique(classes, return_index=True)
                new = np.fromiter((name not in described for name in names.tolist()), bool, len(names))
                if len(described) > DESCRIBED:
                    described.clear()
                described.update(names[new].tolist())
                heads = np.sort(heads[new])
                size = found["size"][heads]
                word = found["word"][np.repeat(found["first"][heads], size) + within(size)]
                rank, code = coded(word)
                order = by_rarity(size, rank)
                rank, code = rank[order], code[order]
                place = within(size)
                leading = np.flatnonzero(place < np.repeat(size + (-percent * size // 100) + 1, size))
                leading = leading[in_filter(twice, _signed(word[order[leading]]))]
                ends = np.searchsorted(leading, np.concatenate([[0], np.cumsum(size)]))
                buffers = [None, pa.py_buffer((4 * ends).astype(np.int32).tobytes()), pa.py_buffer(place[leading].astype("<u4").tobytes())]
                places = pa.Array.from_buffers(pa.binary(), len(size), buffers)
                named = leading[rank[leading] >= often]
                ends = pa.array(np.searchsorted(named, np.concatenate([[0], np.cumsum(size)])), pa.int32())
                named = pa.ListArray.from_arrays(ends, pa.array(_signed(code[named])))
                n, more = len(classes), len(part)
                every = np.concatenate([found["text"], np.arange(more)]) + at
                none = np.arange(n + more) >= n
                pick = np.full(n + more, -1)
                pick[heads] = np.arange(len(heads))
                take = pa.array(pick, mask=pick < 0)

                def column(values: np.ndarray, kind: pa.DataType) -> pa.Array:
                    return pa.array(np.concatenate([values, np.zeros(more, np.int64)]), kind, mask=none)

                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rows[every]), batch.column(1).take(pa.array(every)), column(found["number"], pa.int32()),
                        column(classes, pa.int64()), column(found["size"], pa.int32()),
                        places.take(take), named.take(take), packed(size, rank, code).take(take),
                    ],
                    ["row", "doc_id", "line", "class", "size", "places", "often", "words"],
                )
                at += more

    return texts.mapInArrow(work, LINES.format(id=f"doc_id {id_type}"))


def least_often(counts: DataFrame, known: int) -> int:
    """From which place by rarity on words may lead more than one block of classes; from 0 on, if others than known ones may."""
    return max(0, known + 1 - counts.filter(F.col("n") > BLOCK).count())


def frequent_leads(heads: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(code, blocks) of the words that lead more than one block of classes; at most KNOWN_WORDS, the most frequent."""
    counts = heads.select(F.explode("often").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    found = counts.filter(F.col("n") > BLOCK).orderBy(F.desc("n"), "word").limit(KNOWN_WORDS).orderBy("word").toPandas()
    return found["word"].to_numpy(np.int64), -(-found["n"].to_numpy(np.int64) // BLOCK)


#: what a row of a prefix's word says, before its parity map: the class, parts of the hashes of the word and of the word before
LEAD = {
    "class": np.int64, "word": np.uint32, "before": np.uint32, "before2": np.uint16, "cell": np.int64, "size": np.int32, "place": np.int32,
}


def blobs(key: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, list[bytes]]:
    """Rows of one key as one blob, the first bytes of all values first; so equal bytes stand together."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    raw = np.concatenate([np.ascontiguousarray(c).view(np.uint8).reshape(len(key), c.itemsize) for c in columns], axis=1)[order]
    edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]])) if len(key) else np.zeros(1, np.int64)
    return key[edges[:-1]], [raw[i:j].T.tobytes() for i, j in zip(edges[:-1].tolist(), edges[1:].tolist())]


def columns_of(found: list[bytes], kinds: list[type]) -> list[np.ndarray]:
    """The columns of all rows in some blobs."""
    widths = [np.dtype(kind).itemsize for kind in kinds]
    raw = np.concatenate([np.frombuffer(blob, np.uint8).reshape(sum(widths), -1).T for blob in found])
    ends = np.cumsum(widths)
    return [np.ascontiguousarray(raw[:, end - width : end]).view(kind).ravel() for end, width, kind in zip(ends, widths, kinds)]


def leads(heads: DataFrame, parts: int) -> DataFrame:
    """(part, lanes, rows): for every word of a prefix its cell, place and the word before, and the class with its size and parity map.

    A cell names the two blocks that meet, and whether the class is of the
    first. Words are cut to what tells those of a part apart; where that
    fails, more classes pass than need to.
    """
    words, blocks = frequent_leads(heads)
    shared = heads.sparkSession.sparkContext.broadcast((words.tobytes(), blocks.tobytes()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, blocks = (np.frombuffer(b, np.int64) for b in shared.value)
        held: dict[int, list[tuple[np.ndarray, ...]]] = {1: [], 2: [], 4: []}

        def gathered() -> pa.RecordBatch:
            keys, wide, rows = [], [], []
            for n, batches in held.items():
                if batches:
                    part, *columns = (np.concatenate(values) for values in zip(*batches))
                    batches.clear()
                    key, found = blobs(part, columns)
                    keys, wide, rows = [*keys, *key.tolist()], [*wide, *[n] * len(key)], [*rows, *found]
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(wide, pa.int32()), pa.array(rows, pa.binary())], ["part", "lanes", "rows"])

        for batch in batches:
            length, _, code = unpacked(batch.column("words"))
            first = np.cumsum(length) - length
            maps = parity_maps(code, first)
            places = batch.column("places")
            count = pc.binary_length(places).to_numpy() // 4
            owner, place = np.repeat(np.arange(len(count)), count), np.frombuffer(b"".join(places.to_pylist()), "<u4").astype(np.int64)
            at = first[owner] + place
            word = code[at]
            # 0 where there is none; the parts sent tell two words apart like a hash of 47 bits
            before = np.where(place > 0, arrays.mixed(code[at - 1] + np.uint64(1)) | np.uint64(1), np.uint64(0))
            n = np.ones(len(word), np.int64)
            if len(frequent):
                spot = np.searchsorted(frequent, word.view(np.int64))
                spot[spot == len(frequent)] = 0
                n = np.where(frequent[spot] == word.view(np.int64), blocks[spot], 1)
            own = batch.column("class").to_numpy()[owner].view(np.uint64) % n.astype(np.uint64)
            own, other = np.repeat(own.astype(np.int64), n), within(n)
            low, high = np.minimum(own, other), np.maximum(own, other)
            meeting = low << 31 | high
            owner, word, before, place = (np.repeat(c, n) for c in (owner, arrays.mixed(word), before, place))
            part = arrays.mixed(word + meeting.astype(np.uint64)) % np.uint64(parts)
            name, size = (batch.column(c).to_numpy()[owner] for c in ("class", "size"))
            columns = [
                part.astype(np.int32), name, word.astype(np.uint32), before.astype(np.uint32), (before >> np.uint64(32)).astype(np.uint16),
                meeting << 1 | (own == low), size.astype(np.int32), place.astype(np.int32),
            ]
            lanes = lanes_of(size)
            for n, rows in held.items():
                some = np.flatnonzero(lanes == n)
                rows.append((*(c[some] for c in columns), *folded(maps[owner[some]], n).T))
            if sum(len(columns[0]) for rows in held.values() for columns in rows) > GATHERED:
                yield gathered()
        if held[1]:
            yield gathered()

    return heads.select("class", "size", "places", "words").mapInArrow(work, "part int, lanes int, rows binary")


class Entries:
    """Rows that stand for a word of a class's prefix in a cell, sorted so that partners come later in a group."""

    def __init__(self, word: np.ndarray, cell: np.ndarray, size: np.ndarray, name: np.ndarray):
        order = np.lexsort((name, size, cell >> 1, word))
        w, c, n = word[order], cell[order], name[order]
        new = np.ones(len(order), bool)
        new[1:] = (w[1:] != w[:-1]) | (c[1:] != c[:-1]) | (n[1:] != n[:-1])
        #: which rows are kept, in order; one class may come from several tasks
        self.order = order[new]
        self.word, self.cell, self.size = word[self.order], cell[self.order], size[self.order].astype(np.int64)
        self.meeting, self.first_block = self.cell >> 1, (self.cell & 1).astype(bool)
        self.across = (self.meeting >> 31) != (self.meeting & ((1 << 31) - 1))

    def pairs(self, percent: int, place: np.ndarray, before: np.ndarray, maps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places (i, j) in the sorted list that pass the length, positional and parity filters.

        Sets that share the word before this one have met there.
        """
        place, before, maps = place[self.order], before[self.order], maps[self.order]
        parity, lanes = folded(maps, 1).ravel(), lanes_of(self.size)
        new = np.ones(len(self.word), bool)
        new[1:] = (self.word[1:] != self.word[:-1]) | (self.meeting[1:] != self.meeting[:-1])
        group = np.cumsum(new)
        widest = int(self.size.max()) + 2
        # a partner is at most so much larger
        stop = np.searchsorted(group * widest + self.size, group * widest + np.minimum(100 * self.size // percent, widest - 1), "right")
        partners = stop - np.arange(len(stop)) - 1
        behind = self.size - place
        for run in runs(partners, PAIRS):
            i = np.repeat(np.arange(run.start, run.stop), partners[run])
            j = i + 1 + within(partners[run])
            both = self.size[i] + self.size[j]
            overlap = -(-percent * both // (100 + percent))
            fits = np.flatnonzero(np.minimum(behind[i], behind[j]) >= overlap)
            i, j, apart = i[fits], j[fits], (both - 2 * overlap)[fits]
            fits = np.bitwise_count(parity[i] ^ parity[j]) <= apart
            i, j, apart = i[fits], j[fits], apart[fits]
            fits = ((before[i] != before[j]) | (before[i] == 0)) & (~self.across[i] | (self.first_block[i] != self.first_block[j]))
            i, j, apart = i[fits], j[fits], apart[fits]
            width = np.minimum(lanes[i], lanes[j])
            good = width == 1
            for n in (2, 4):
                some = np.flatnonzero(width == n)
                differing = np.bitwise_count(folded(maps[i[some]] ^ maps[j[some]], n)).sum(axis=1, dtype=np.int64)
                good[some] = differing <= apart[some]
            yield i[good], j[good]


#: what a candidate tells of each word under which it found another
FOUND = {name: LEAD[name] for name in ("cell", "place")}


def candidates(heads: DataFrame, parts: int, percent: int) -> DataFrame:
    """(part, class, found): the rows of ``leads`` that pass all filters with another class of their word and cell."""

    def narrow(part: pa.Table) -> pa.Table:
        held = []
        for n in (1, 2, 4):
            rows = part.filter(pc.equal(part.column("lanes"), n)).column("rows").to_pylist()
            if rows:
                columns = columns_of(rows, [*LEAD.values(), *[np.uint64] * n])
                maps = np.zeros((len(columns[0]), 4), np.uint64)
                maps[:, :n] = np.stack(columns[len(LEAD) :], axis=1)
                held.append([*columns[: len(LEAD)], maps])
        *columns, maps = (np.concatenate(values) for values in zip(*held))
        column = dict(zip(LEAD, columns))
        before = column["before"] | column["before2"].astype(np.uint64) << np.uint64(32)
        entries = Entries(column["word"], column["cell"], column["size"], column["class"])
        some = np.zeros(len(entries.order), bool)
        for i, j in entries.pairs(percent, column["place"], before, maps):
            some[i] = some[j] = True
        kept = entries.order[some]
        names, found = blobs(column["class"][kept], [column[name][kept] for name in FOUND])
        number = part.column("part")[0].as_py()
        return pa.table({"part": pa.array([number] * len(names), pa.int32()), "class": pa.array(names, pa.int64()), "found": pa.array(found, pa.binary())})

    return leads(heads, parts).groupBy("part").applyInArrow(narrow, "part int, class long, found binary")


def linked(heads: DataFrame, firsts: DataFrame, percent: int) -> DataFrame:
    """(class, n_links, met): how many other classes match, and the earliest place of any of them."""
    total = heads.agg(F.sum(F.octet_length("places"))).first()[0] or 0
    parts = max(1, -(-total // (4 * PART_WORDS)))
    found = stored(candidates(heads, parts, percent), "line-candidates")
    shared = heads.sparkSession.sparkContext.broadcast(bit_filter(found, "class").tobytes())
    layout = T.StructType().add("class", "long").add("n_links", "long").add("met", firsts.schema["first"].dataType)

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            yield batch.filter(pa.array(in_filter(bits, batch.column(0).to_numpy())))

    def link(part: pa.Table) -> pa.Table:
        part = part.combine_chunks()
        sets = Sets(part.column("words").chunk(0))
        found = part.column("found").to_pylist()
        width = sum(np.dtype(kind).itemsize for kind in FOUND.values())
        owner = np.repeat(np.arange(part.num_rows), [len(rows) // width for rows in found])
        cell, place = columns_of(found, list(FOUND.values()))
        at = sets.begin[owner] + place
        before = np.where(place > 0, sets.word[at - 1] + 1, 0)
        places = part.select(["first"])
        while any(pa.types.is_struct(kind) for kind in places.schema.types):
            places = places.flatten()
        places = places.rename_columns([str(n) for n in range(places.num_columns)])
        by_place = pc.sort_indices(places, [(name, "ascending") for name in places.column_names], null_placement="at_start").to_numpy()
        turn = np.empty(len(by_place), np.int64)
        turn[by_place] = np.arange(len(by_place))
        n = np.zeros(len(turn), np.int64)
        earliest = np.full(len(turn), len(turn))
        entries = Entries(sets.word[at], cell, sets.size[owner], owner)
        for i, j in entries.pairs(percent, place, before, sets.parity()[owner]):
            a, b = owner[entries.order[i]], owner[entries.order[j]]
            both = sets.size[a] + sets.size[b]
            for few in runs(both, WORDS):
                common, first = sets.shared(a[few], b[few])
                good = (first == entries.word[i[few]]) & (100 * common >= percent * (both[few] - common))
                for x, y in ((a[few][good], b[few][good]), (b[few][good], a[few][good])):
                    n += np.bincount(x, minlength=len(n))
                    np.minimum.at(earliest, x, turn[y])
        hit = np.flatnonzero(n)
        met = part.column("first").take(pa.array(by_place[earliest[hit]]))
        return pa.table({"class": part.column("class").take(pa.array(hit)), "n_links": pa.array(n[hit]), "met": met})

    # a class that comes from several tasks has one set
    sets = heads.select("class", "words").mapInArrow(wanted, "class long, words binary").dropDuplicates(["class"])
    rows = found.join(sets, "class").join(firsts, "class")
    links = rows.groupBy("part").applyInArrow(link, layout)
    return links.groupBy("class").agg(F.sum("n_links").alias("n_links"), F.min("met").alias("met"))


def line_links(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(lines, classes): every line with its class and place, and every class with its first place and its links."""
    bounded_batches(docs.sparkSession)
    texts = docs.select(utf8(text_col).alias("bytes"))
    counts = stored(word_counts(texts), "word-counts")
    known_words = frequent_words(counts)
    bits = bit_filter(counts.filter("n > 1"), "word")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), utf8(text_col).alias("bytes"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    lines = stored(_described(rows, known_words, least_often(counts, len(known_words[0])), bits, percent, id_type), "lines")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "line")
    firsts = lines.filter("line is not null").groupBy("class").agg(F.min(place).alias("first"))
    # every task that met a class has described it
    links = linked(lines.filter("words is not null and octet_length(places) > 0"), firsts, percent)
    found = firsts.join(links, "class", "left")
    return lines.select("row", "doc_id", "line", "class", place.alias("place")), found


def judged(docs: DataFrame, percent: int = PERCENT, **columns) -> DataFrame:
    """Every line with words, and a null line per row: (row, doc_id, line, class, n_links, removed)."""
    lines, classes = line_links(docs, percent, **columns)
    verdict = classes.select(
        "class", F.least("first", F.coalesce("met", "first")).alias("first"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    )
    found = lines.filter("line is not null").join(verdict, "class").select(
        "row", "doc_id", "line", "class", "n_links", (F.col("first") < F.col("place")).alias("removed")
    )
    rest = lines.filter("line is null").select(
        "row", "doc_id", "line", "class", F.lit(0).cast("long").alias("n_links"), F.lit(False).alias("removed")
    )
    return found.unionByName(rest)


def report(docs: DataFrame, percent: int = PERCENT, **columns) -> DataFrame:
    """Per row: lines with words, their links to other classes, and the numbers of the lines removed."""
    lines = judged(docs, percent, **columns)
    gone = F.array_sort(F.collect_list(F.when(F.col("removed"), F.col("line"))))
    return (
        lines.groupBy("row", "doc_id")
        .agg(F.count("line").alias("n_lines"), F.sum("n_links").alias("n_links"), gone.alias("gone"))
        .select(
            "doc_id", "n_lines", "n_links", F.size("gone").cast("long").alias("n_removed"), F.array_join("gone", ",").alias("removed_lines")
        )
    )


def without_repeated_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Rows (doc_id, text) without the removed lines; rows of equal id and text lose the same lines."""
    key = F.md5(utf8("text"))
    rows = docs.select("doc_id", "text").withColumn("_key", key)
    marked = rows.groupBy("doc_id", "_key").agg(F.first("text").alias("text"), F.count("*").alias("_n"))
    single = stored(marked.select("doc_id", "_key", "text", "_n"), "line-texts")
    numbered = single.withColumn("place", F.struct("doc_id", "_key"))
    found = judged(numbered.select(F.col("place").alias("doc_id"), "text"), percent)
    gone = found.filter("removed").groupBy("doc_id").agg(F.collect_set("line").alias("gone"))
    joined = numbered.join(gone, numbered["place"].eqNullSafe(gone["doc_id"]), "left").select(numbered["doc_id"], "text", "_n", "gone")
    kept = F.filter(F.transform(F.split("text", "\n", -1), lambda t, i: F.struct(t.alias("t"), i.alias("i"))), lambda x: F.col("gone").isNull() | ~F.array_contains("gone", x["i"]))
    text = F.array_join(F.transform(kept, lambda x: x["t"]), "\n")
    return joined.select("doc_id", F.when(F.col("text").isNotNull(), text).alias("text"), F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_copy")).drop("_copy")
