"""Repeated passages by prefix doubling over sampled suffixes.

Every byte covered by a string of ``threshold`` bytes that also starts
elsewhere, in any text or in the same one, is removed. Strings are judged on
the input, never cross texts, and may overlap.

Prefix doubling ranks suffixes by their first bytes, then by pairs of ranks at
growing offsets. Doing so for every byte would move many times the input, so
the suffixes are sampled: a string of ``threshold`` bytes is represented by
the position, among those with enough bytes behind it, whose first bytes have
the smallest hash. The choice depends on the string alone, so equal strings
choose alike, and one position represents a whole run of neighbouring strings.

1. Each sampled position brings a name for its first bytes and for the bytes
   at each doubled offset. Spark groups (rank, name at the offset), positions
   whose pair is unique drop out, the others take the pair as their rank, and
   so on past the last offset.
2. Positions left share their rank. Runs of strings that are equal as a whole
   are settled by that. Of the others one example of each is fetched, and its
   strings are compared within the rank. A rank with very many different runs
   is compared string by string in a Spark aggregation instead.
3. The repeated stretches are gathered per text and cut out.

Hashes have 64 bits, and two independent ones must agree before strings count
as equal. Nulls and texts shorter than the threshold lose nothing. Equal texts
are treated alike, so repeated rows and ids need no rule; null ids are kept.
An empty table gives an empty result; further columns are ignored.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm import arrays
from millwright.llm.common import bit_filter, bounded_batches, in_filter, stored, text_struct, utf8

THRESHOLD = 400
#: different runs of one rank that one task compares
RANK_RUNS = 4096

MARK = "key binary, at long, strings int, before int, rank long, next_1 long, next_2 long, run long"


def reach(threshold: int) -> int:
    """Bytes by which sampled positions are ranked: four times the first rank's."""
    return max(4, 1 << ((threshold // 3).bit_length() - 1))


def _pieces(texts: list[bytes], threshold: int) -> Iterator[tuple[int, int, bytes]]:
    """(text number, offset, bytes): long texts in pieces that overlap by a string less one byte."""
    for number, text in enumerate(texts):
        for at in range(0, max(1, len(text) - threshold + 1), arrays.PART_BYTES):
            piece = text[at : at + arrays.PART_BYTES + threshold - 1]
            if len(piece) >= threshold:
                yield number, at, piece


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Per index the place of the smallest of the next ``width`` values, the first of equals."""
    place = np.arange(len(values), dtype=np.int32)
    least = values

    def better(shift: int) -> tuple[np.ndarray, np.ndarray]:
        low, at = least.copy(), place.copy()
        take = least[shift:] < least[:-shift]
        low[:-shift][take] = least[shift:][take]
        at[:-shift][take] = place[shift:][take]
        return low, at

    span = 1
    while span * 2 <= width:
        least, place = better(span)
        span *= 2
    if span < width and len(values) > width - span:
        least, place = better(width - span)
    return place


def sampled(texts: list[bytes], threshold: int, ranked: bool = True) -> dict[str, np.ndarray]:
    """The runs of the texts: one sampled position and the strings it represents, with its names if ``ranked``."""
    first = reach(threshold) // 4
    width = threshold - 4 * first + 1
    out: dict[str, list] = {name: [] for name in ("text", "at", "strings", "before", "rank", "next_1", "next_2", "run")}
    waiting: list[tuple[int, int, bytes]] = []

    def flush() -> None:
        if not waiting:
            return
        numbers, offsets, pieces = zip(*waiting)
        data, begins = arrays.laid_out(list(pieces))
        sizes = np.array([len(piece) for piece in pieces])
        starts = np.arange(len(data) - first + 1)
        name = arrays.span_hasher(data)
        names = name(starts, starts + first)
        place = _smallest((names >> np.uint64(32)).astype(np.uint32), width)
        owner = np.repeat(np.arange(len(pieces)), sizes - threshold + 1)
        counts = sizes - threshold + 1
        string = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + begins[owner]
        chosen = place[string]
        new = np.ones(len(string), bool)
        new[1:] = (chosen[1:] != chosen[:-1]) | (owner[1:] != owner[:-1])
        head = np.flatnonzero(new)
        strings = np.diff(np.concatenate([head, [len(string)]]))
        low, spot, piece = string[head], chosen[head], owner[head]

        found = {
            "text": np.array(numbers)[piece],
            "at": low - begins[piece] + np.array(offsets)[piece],
            "strings": strings,
            "before": spot - low,
            "run": name(low, low + strings - 1 + threshold),
        }
        if ranked:
            found["rank"] = names[spot]
            found["next_1"] = name(spot + first, spot + 2 * first)
            found["next_2"] = name(spot + 2 * first, spot + 4 * first)
        for column, values in found.items():
            out[column].append(values)
        waiting.clear()

    held = 0
    for piece in _pieces(texts, threshold):
        if held + len(piece[2]) > arrays.PART_BYTES:
            flush()
            held = 0
        waiting.append(piece)
        held += len(piece[2]) + 1
    flush()
    return {column: np.concatenate(values) if values else np.zeros(0, np.int64) for column, values in out.items()}


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).astype(np.uint64).view(np.int64))


def marks(texts: DataFrame, threshold: int) -> DataFrame:
    """One row per run of each text (column ``bytes``); the key is the text's digest."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [text for text in batch.column(0).to_pylist() if len(text) >= threshold]
            found = sampled(held, threshold)
            keys = np.array([hashlib.md5(text).digest() for text in held] + [None], object)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys[found["text"].astype(np.int64)], pa.binary()),
                    _longs(found["at"]),
                    *(pa.array(found[c].astype(np.int32)) for c in ("strings", "before")),
                    *(_longs(found[c]) for c in ("rank", "next_1", "next_2", "run")),
                ],
                [part.split()[0] for part in MARK.split(", ")],
            )

    return texts.mapInArrow(work, MARK)


def doubled(rows: DataFrame, names: list[str]) -> DataFrame:
    """Rows whose ``rank`` is shared by another, ranked anew by the pair with each name in turn.

    Unique pairs drop out after each offset. The counts are combined before
    their shuffle, and a rank of very many rows is split by the adaptive join.
    """
    for name in [None, *names]:
        pair = ["rank", name] if name else ["rank"]
        shared = rows.groupBy(*pair).agg(F.count("*").alias("_n")).filter("_n > 1").drop("_n")
        # stored, so that both sides of the join are plain shuffles, which can be split where one rank is large
        rows = rows.join(stored(shared, "shared-ranks"), pair, "left_semi")
        if name:
            rows = rows.withColumn("rank", F.xxhash64(*pair)).drop(name)
    return rows


def _examples(texts: DataFrame, wanted: DataFrame, threshold: int) -> DataFrame:
    """(run, before, strings, bytes) of each wanted run, read again from the texts."""
    shared = texts.sparkSession.sparkContext.broadcast(bit_filter(wanted, "run").tobytes())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            held = [text for text in batch.column(0).to_pylist() if len(text) >= threshold]
            found = sampled(held, threshold, ranked=False)
            runs = found["run"].astype(np.uint64).view(np.int64)
            hit = np.flatnonzero(in_filter(bits, runs)) if len(runs) else np.zeros(0, np.int64)
            if len(hit):
                same = np.stack([runs[hit], found["before"][hit], found["strings"][hit]])
                hit = hit[np.unique(same, axis=1, return_index=True)[1]]
            cut = [
                held[text][at : at + strings - 1 + threshold]
                for text, at, strings in zip(*(found[c][hit].tolist() for c in ("text", "at", "strings")))
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(runs[hit]),
                    *(pa.array(found[c][hit].astype(np.int32)) for c in ("before", "strings")),
                    pa.array(cut, pa.binary()),
                ],
                ["run", "before", "strings", "bytes"],
            )

    rows = texts.mapInArrow(work, "run long, before int, strings int, bytes binary")
    return rows.dropDuplicates(["run", "before", "strings"])


def _string_hashes(slices: list[bytes], strings: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each string of each slice: the slice's number, the offset, the hash."""
    numbers, offsets, hashes = [], [], []
    at = 0
    for part in arrays.parts(slices):
        data, begins = arrays.laid_out(part)
        counts = strings[at : at + len(part)]
        number = np.repeat(np.arange(len(part)), counts)
        offset = np.arange(len(number)) - np.repeat(np.cumsum(counts) - counts, counts)
        start = begins[number] + offset
        numbers.append(number + at)
        offsets.append(offset)
        hashes.append(arrays.span_hashes(data, start, start + threshold))
        at += len(part)
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (numbers, offsets, hashes))


def _stretches(number: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbouring offsets of a number as (number, first, last)."""
    edge = np.ones(len(number), bool)
    edge[1:] = (number[1:] != number[:-1]) | (offset[1:] != offset[:-1] + 1)
    head = np.flatnonzero(edge)
    tail = np.concatenate([head[1:], [len(number)]]) - 1
    return number[head], offset[head], offset[tail[: len(head)]]


PARTIAL = "rank long, run long, before int, strings int, first int, last int"


def _compared(examples: DataFrame, threshold: int) -> DataFrame:
    """Repeated stretches of the examples: string offsets ``first`` to ``last`` within the run."""

    def compare(table: pa.Table) -> pa.Table:
        slices = table.column("bytes").to_pylist()
        columns = {c: table.column(c).to_numpy() for c in ("rank", "run", "before", "strings")}
        number, offset, value = _string_hashes(slices, columns["strings"].astype(np.int64), threshold)
        # strings of different ranks never agree
        value = arrays.mixed(value + arrays.mixed(columns["rank"][number].view(np.uint64)))
        order = np.argsort(value, kind="stable")
        same = value[order][1:] == value[order][:-1]
        again = np.zeros(len(value), bool)
        again[order[1:]] |= same
        again[order[:-1]] |= same
        who, first, last = _stretches(number[again], offset[again])
        return pa.table(
            {c: columns[c][who] for c in ("rank", "run", "before", "strings")}
            | {"first": first.astype(np.int32), "last": last.astype(np.int32)}
        )

    sizes = examples.groupBy("rank").agg(F.count("*").alias("_n"))
    crowded = stored(sizes.filter(F.col("_n") > RANK_RUNS).select("rank"), "crowded-ranks")
    usual = examples.join(crowded, "rank", "left_anti")
    groups = max(1, -(-examples.count() // RANK_RUNS))
    small = usual.withColumn("_part", F.pmod(F.xxhash64("rank"), F.lit(groups)))
    found = small.groupBy("_part").applyInArrow(compare, PARTIAL)
    if crowded.isEmpty():
        return found

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {c: batch.column(c).to_numpy() for c in ("rank", "run", "before", "strings")}
            number, offset, value = _string_hashes(batch.column("bytes").to_pylist(), columns["strings"].astype(np.int64), threshold)
            yield pa.RecordBatch.from_pydict(
                {c: columns[c][number] for c in ("rank", "run", "before", "strings")}
                | {"offset": offset.astype(np.int32), "value": value.astype(np.uint64).view(np.int64)}
            )

    many = examples.join(crowded, "rank", "left_semi").select("rank", "run", "before", "strings", "bytes")
    each = stored(many.mapInArrow(strings, "rank long, run long, before int, strings int, offset int, value long"), "strings")
    shared = each.groupBy("rank", "value").agg(F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    again = each.join(shared, ["rank", "value"], "left_semi")
    return found.unionByName(
        again.select("rank", "run", "before", "strings", F.col("offset").alias("first"), F.col("offset").alias("last"))
    )


def repeats(texts: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(key, spans): per text digest the byte ranges [start, end) to remove, in order and apart.

    ``texts`` has one column ``bytes``.
    """
    all_marks = stored(marks(texts, threshold), "marks")
    alive = stored(doubled(all_marks, ["next_1", "next_2"]), "marks-alive")
    run = ["rank", "run", "before", "strings"]
    runs = stored(alive.groupBy(*run).agg(F.count("*").alias("n")), "runs")
    mixed_ranks = runs.groupBy("rank").agg(F.count("*").alias("_n"), F.min("n").alias("_least")).filter("_n > 1 and _least = 1")
    unsettled = stored(runs.join(mixed_ranks.select("rank"), "rank", "left_semi"), "runs-unsettled")
    examples = stored(
        unsettled.join(_examples(texts, unsettled, threshold), ["run", "before", "strings"]).select(*run, "n", "bytes"), "examples"
    )
    partly = _compared(examples, threshold)
    whole = runs.filter("n > 1").select(*run, F.lit(0).alias("first"), (F.col("strings") - 1).alias("last"))
    lone = runs.filter("n = 1").select(*run)
    hits = stored(whole.unionByName(partly.join(lone, run, "left_semi")), "run-stretches")
    placed = alive.join(hits, run).select(
        "key", F.struct((F.col("at") + F.col("first")).alias("start"), (F.col("at") + F.col("last") + threshold).alias("end")).alias("s")
    )
    gathered = placed.groupBy("key").agg(F.array_sort(F.collect_set("s")).alias("spans"))
    return gathered.select("key", F.col("spans"))


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for span in spans:
        if out and span["start"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], span["end"])
        else:
            out.append([span["start"], span["end"]])
    return [(a, b) for a, b in out]


def _cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(edge for span in spans for edge in span), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def without_repeats(docs: DataFrame, threshold: int = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, ``spans`` removed (start, end in bytes) and the remaining bytes ``kept``.

    Only texts that may have a repeat, by a filter of fixed size, are shuffled.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    found = stored(repeats(docs.select(utf8(text_col).alias("bytes")), threshold), "repeats")
    slot_of = F.conv(F.substring(F.hex("key"), 1, 15), 16, 10).cast("long")
    shared = spark.sparkContext.broadcast(bit_filter(found.select(slot_of.alias("slot")), "slot").tobytes())

    def prepare():
        bits = np.frombuffer(shared.value, np.uint8)

        def work(texts: list[bytes]) -> dict:
            keys = [hashlib.md5(text).digest() for text in texts]
            slots = np.array([int(key.hex()[:15], 16) for key in keys], np.int64)
            return {"key": keys, "maybe": in_filter(bits, slots)}

        return work

    rows = docs.select(F.col(id_col).alias("doc_id"), utf8(text_col).alias("bytes"))
    seen = rows.withColumn("seen", text_struct(prepare, "key binary, maybe boolean")(F.col("bytes").cast("string")))
    seen = seen.select("doc_id", "bytes", "seen.key", "seen.maybe")
    clean = seen.filter("not maybe").select("doc_id", "bytes", F.lit(None).cast(found.schema["spans"].dataType).alias("spans"))
    hit = seen.filter("maybe").join(found, "key", "left").select("doc_id", "bytes", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            texts, spans = batch.column(1).to_pylist(), [_merged(s or []) for s in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], kind),
                    pa.array([_cut(text, s) for text, s in zip(texts, spans)], pa.binary()),
                ],
                ["doc_id", "spans", "kept"],
            )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return clean.unionByName(hit).mapInArrow(cut, f"doc_id {id_type}, spans array<struct<start:long,end:long>>, kept binary")


def report(docs: DataFrame, threshold: int = THRESHOLD, **columns) -> DataFrame:
    """Per row: bytes, bytes and spans removed, and the digest of what remains."""
    rows = without_repeats(docs, threshold, **columns)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return rows.select(
        "doc_id",
        (F.octet_length("kept") + removed).alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
