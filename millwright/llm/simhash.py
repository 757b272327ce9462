"""Near copies by SimHash fingerprints and a hierarchical index in Gray order.

A text is lower-cased (A-Z) and split at ASCII white space; every run of
three words, repeats included, votes with its 64-bit hash. Two texts are
linked when their fingerprints differ in at most three bits, and linked texts
form a component.

The index is a tree of masked bit patterns. Its top nodes fix one of four
blocks of bits: two codes that differ in three bits agree in one block, so
each pair meets below a common top node. Codes below a node are sorted by
their rank in the Gray sequence, neighbours are gathered under nodes that
hold the bits they share, and a pair of nodes is dropped as soon as the
differences accumulated on the way down exceed the limit. A top node with too
many codes for one task fixes further bits by the same rule.

A null or empty text has fingerprint zero and is linked like any other. Null
ids never name a component, but their rows are returned. Repeated rows share
their fingerprint. An empty table gives an empty result; further columns are
ignored.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.common import bounded_batches, fresh, stored, text_struct
from millwright.llm.components import components

SHINGLE = 3
DISTANCE = 3
SEED = 42
#: codes below one top node beyond which it is split
NODE_CODES = 8192
#: index rows that one group of top nodes should hold
GROUP_ROWS = 20_000
#: codes that are compared directly, without nodes in between
LEAF = 32
FAN = 8
_FRONTIER = 1 << 17


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text, as an unsigned number."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    stops = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate([[0], stops[:-1] + 1])
    last = max(1, len(words) - shingle + 1)
    ends = stops[min(shingle, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    for at in range(0, last, 1 << 16):
        hashes = np.array(
            [
                digest(joined[a:b], SEED)
                for a, b in zip(starts[at : min(last, at + (1 << 16))].tolist(), ends[at : at + (1 << 16)].tolist())
            ],
            np.uint64,
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    set_bits = (votes * 2 > last).astype(np.uint8)
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, shingle: int = SHINGLE, text_col: str = "text", into: str = "code") -> DataFrame:
    """``docs`` with the fingerprint as a signed long."""
    bounded_batches(docs.sparkSession)

    def prepare():
        return lambda texts: {"code": np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)}

    return docs.withColumn(into, text_struct(prepare, "code long")(text_col)["code"])


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Where each code stands in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def close_pairs(codes: np.ndarray, distance: int):
    """Yields arrays (i, j), i < j, of codes that differ in at most ``distance`` bits.

    ``codes`` are distinct and in Gray order. Going down from the root, a pair
    of nodes carries the differences found in the bits shared so far; only the
    bits that the children share in addition are counted.
    """
    ones, zeros = [codes], [~codes]
    while len(ones[-1]) > 1:
        cuts = np.arange(0, len(ones[-1]), FAN)
        ones.append(np.bitwise_and.reduceat(ones[-1], cuts))
        zeros.append(np.bitwise_and.reduceat(zeros[-1], cuts))
    top = len(ones) - 1
    shared = ones[top] | zeros[top]
    waiting = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64), shared[:1])]
    steps = np.arange(FAN)
    while waiting:
        level, a, b, so_far, fixed = waiting.pop()
        if level == 0:
            found = a < b
            if found.any():
                yield a[found], b[found]
            continue
        if len(a) > _FRONTIER // (FAN * FAN):
            half = len(a) // 2
            waiting += [(level, a[s], b[s], so_far[s], fixed[s]) for s in (slice(half), slice(half, None))]
            continue
        size = len(ones[level - 1])
        left = (a[:, None, None] * FAN + steps[:, None] + 0 * steps).ravel()
        right = (b[:, None, None] * FAN + steps + 0 * steps[:, None]).ravel()
        keep = (left <= right) & (right < size) & (left < size)
        left, right = left[keep], right[keep]
        so_far, fixed = np.repeat(so_far, FAN * FAN)[keep], np.repeat(fixed, FAN * FAN)[keep]
        one, zero = ones[level - 1], zeros[level - 1]
        both = (one[left] | zero[left]) & (one[right] | zero[right])
        differ = (one[left] ^ one[right]) & both & ~fixed
        so_far = so_far + np.bitwise_count(differ)
        near = so_far <= distance
        if near.any():
            waiting.append((level - 1, left[near], right[near], so_far[near], both[near]))


def _joined(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give both ends of every pair one label, the smallest of their classes."""
    while True:
        x, y = labels[a], labels[b]
        if (x == y).all():
            return
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while (labels[labels] != labels).any():
            labels[:] = labels[labels]


def node_links(mask: np.ndarray, value: np.ndarray, codes: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among the codes below each top node (mask, value), as (code, another) with few repeats.

    Within this group of nodes the links found are reduced to one per code, so
    a dense set of near copies costs as many rows as it has codes.
    """
    order = np.lexsort((gray_rank(codes), value, mask))
    mask, value, codes = mask[order], value[order], codes[order]
    distinct, number = np.unique(codes, return_inverse=True)
    labels = np.arange(len(distinct))
    edge = np.flatnonzero((mask[1:] != mask[:-1]) | (value[1:] != value[:-1])) + 1
    starts = np.concatenate([[0], edge])
    sizes = np.diff(np.concatenate([starts, [len(codes)]]))
    node = np.repeat(np.arange(len(starts)), sizes)
    small = np.repeat(sizes <= LEAF, sizes)
    for shift in range(1, min(LEAF, len(codes))):
        near = (node[shift:] == node[:-shift]) & small[shift:]
        near &= np.bitwise_count(codes[shift:] ^ codes[:-shift]) <= distance
        at = np.flatnonzero(near)
        _joined(labels, number[at], number[at + shift])
    for start, size in zip(starts[sizes > LEAF], sizes[sizes > LEAF]):
        held = number[start : start + size]
        for a, b in close_pairs(codes[start : start + size], distance):
            _joined(labels, held[a], held[b])
    moved = labels != np.arange(len(distinct))
    return distinct[moved], distinct[labels[moved]]


def _split_bits(mask: int, parts: int) -> list[int]:
    """The mask with one more block of its free bits fixed, one mask per block."""
    free = [bit for bit in range(64) if not mask >> bit & 1]
    cuts = [len(free) * k // parts for k in range(parts + 1)]
    return [mask | sum(1 << bit for bit in free[a:b]) for a, b in zip(cuts, cuts[1:])]


def _signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def _below(codes: DataFrame, finer: dict[int, list[int]]) -> DataFrame:
    """Index rows of codes under the masks that refine the mask they are ``of``."""
    pairs = [(_signed(mask), _signed(split)) for mask, splits in finer.items() for split in splits]
    # the masks follow from the distance and the depth alone
    table = F.broadcast(codes.sparkSession.createDataFrame(pairs, "of long, mask long"))
    return codes.join(table, "of").select("mask", F.col("code").bitwiseAND(F.col("mask")).alias("value"), "code")


def code_links(codes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links (a, b) between distinct codes (column ``code``) that connect all codes within ``distance``.

    The links span the same components as all pairs within the distance, but
    are far fewer. Top nodes of more than ``NODE_CODES`` codes fix further
    bits, over and over, so no task depends on how codes cluster.
    """
    spark = codes.sparkSession
    masks = _split_bits(0, distance + 1)
    nodes = stored(_below(codes.withColumn("of", F.lit(0).cast("long")), {0: masks}), "codes")
    ready = []
    while True:
        sizes = nodes.groupBy("mask", "value").agg(F.count("*").alias("n"))
        full = stored(sizes.filter(F.col("n") > NODE_CODES).select("mask", "value"), "full-nodes")
        if full.isEmpty():
            ready.append(nodes)
            break
        ready.append(nodes.join(full, ["mask", "value"], "left_anti"))
        crowd = nodes.join(full, ["mask", "value"], "left_semi").select("code", F.col("mask").alias("of"))
        finer = {mask: _split_bits(mask, distance + 1) for mask in masks}
        nodes = stored(_below(crowd, finer).distinct(), "codes")
        masks = sorted({mask for split in finer.values() for mask in split})
    index = ready[0]
    for part in ready[1:]:
        index = index.unionByName(part)
    groups = max(1, -(-index.count() // GROUP_ROWS))

    def link(table: pa.Table) -> pa.Table:
        arrays = [table.column(name).to_numpy() for name in ("mask", "value", "code")]
        a, b = node_links(*(array.astype(np.int64).view(np.uint64) for array in arrays), distance)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    keyed = index.withColumn("part", F.pmod(F.xxhash64("mask", "value"), F.lit(groups)))
    return keyed.groupBy("part").applyInArrow(link, "a long, b long")


def with_component(rows: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Rows (doc_id, code, ...) with the smallest doc_id reachable over links, as ``component_id``."""
    codes = rows.groupBy("code").agg(F.min("doc_id").alias("first_id"))
    member = components(code_links(codes.select("code"), distance)).withColumnRenamed("node", "code")
    linked = codes.join(member, "code", "left").withColumn("component", F.coalesce("component", "code"))
    names = linked.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return rows.join(linked.join(names, "component").select("code", "component_id"), "code")


def report(docs: DataFrame, distance: int = DISTANCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the fingerprint in hex and the component."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    coded = stored(with_fingerprint(rows).select("doc_id", "code"), "fingerprints")
    hexed = F.lower(F.lpad(F.hex("code"), 16, "0"))
    return with_component(coded, distance).select("doc_id", hexed.alias("fingerprint"), "component_id")


def first_of_each(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """The row of each component that has the smallest ``doc_id``, with the columns it came with.

    Of rows with equal ids the smaller digest of the text stays, and of equal
    rows one; a null id comes last.
    """
    bounded_batches(docs.sparkSession)
    mark = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    coded = stored(with_fingerprint(docs.select("doc_id", "text")).select("doc_id", mark.alias("_mark"), "code"), "fingerprints")
    codes = coded.groupBy("code").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_mark")).alias("first")
    )
    member = components(code_links(codes.select("code"), distance)).withColumnRenamed("node", "code")
    linked = codes.join(member, "code", "left").withColumn("component", F.coalesce("component", "code"))
    kept = linked.groupBy("component").agg(F.min("first").alias("first")).select("first.doc_id", "first._mark")
    kept = kept.select(F.col("doc_id").alias("_id"), F.col("_mark").alias("_kept"))
    own = fresh(docs, "_mark")
    marked = docs.withColumn(own, mark)
    same = marked["doc_id"].eqNullSafe(kept["_id"]) & (marked[own] == kept["_kept"])
    return marked.join(kept, same, "left_semi").dropDuplicates(["doc_id", own]).select(*docs.columns)
