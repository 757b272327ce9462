"""Hard negatives: rows of another label that are nearly as close to an anchor as its own.

Every row's vector is taken in whole steps, ``floor(256 * x)`` of each
component as a double; the score of a row for an anchor is their inner
product, higher first, then the smaller id. An anchor's positives are its best
other rows of the same label. For each positive, the best rows of other labels
are returned whose score lies between ``low`` and ``high`` hundredths of the
positive's.

The rows lie in an inverted multi-index: two codebooks, one for each half of
the dimensions, are fitted on ``SAMPLE`` rows, and each pair of codes is a
cell. A cell's bound for an anchor is the sum of two half-scores, each the
inner product with the code's centre plus the anchor's length times the code's
radius, the largest distance of any row from its centre; no row of the cell
scores higher. A multi-sequence heap walks the cells by falling bound. An
anchor is done when the next bound is below all it still needs: the last of
its positives, or, for each window of scores, its lower end or the last of a
full list.

This runs in rounds. In each, a pending anchor asks for its next cells, as
many as hold a number of rows that grows from round to round. Cells are dealt
to tasks in slices of at most about ``SLICE`` rows and the asking anchors in
chunks, so that neither a crowded cell nor many anchors gather in one task.
All rows are indexed and all bounds hold, so the result is the exact one.

Rows with a null label or vector, or with any null or non-finite component,
take no part, nor do vectors that are not as long as most (of equally many,
the longest). A null id comes last and is no anchor. Repeated rows are rows of
their own; only an anchor's own row is not among its positives. Ties of score
and id go by place in the table. An empty table gives an empty result; further
columns are ignored. A score must fit 64 bits.
"""

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwright.llm.common import stored

STEPS = 256
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90
#: rows on which the codebooks are fitted; the bounds hold whatever they are
SAMPLE = 8192
#: codes of each half, and steps of the fit
CODES = 16
FIT_STEPS = 8
#: rows of a cell, and anchors, that meet in one task
SLICE = 1 << 13
CHUNK = 1 << 12
#: rows that an anchor asks for in the first round, and by how much it is more in each further one
FIRST, GROWTH = 8192, 8
#: scores held at a time
SCORES = 1 << 22

Books = tuple[np.ndarray, np.ndarray]


def _whole(x: Column) -> Column:
    """A component in steps, as a double; one too large for a long has no fraction."""
    return F.when(F.abs(x) < 2.0**53, F.floor(x * STEPS).cast("double")).otherwise(x * STEPS)


def usable(vectors: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """(row, vec_id, label, v) of the rows that take part; v in whole steps."""
    parts = F.transform(vector_col, lambda x: x.cast("double"))
    bad = F.exists(parts, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    found = vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"),
        label.cast("long").alias("label"), parts.alias("parts"), bad.alias("bad"),
    ).filter("label is not null and parts is not null and not bad")
    rows = stored(
        found.select("row", "vec_id", "label", F.transform("parts", _whole).alias("v")), "vectors"
    )
    sizes = rows.groupBy(F.size("v").alias("d")).count()
    most = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    return rows.filter(F.size("v") == (most["d"] if most else 0))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1 if len(flat) else 0)


def halves(vectors: np.ndarray) -> Books:
    cut = vectors.shape[1] // 2
    return vectors[:, :cut], vectors[:, cut:]


def nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each point's centre and its distance from it."""
    code = (0.5 * (centres**2).sum(1) - points @ centres.T).argmin(1)
    return code, np.sqrt(((points - centres[code]) ** 2).sum(1))


def codebook(points: np.ndarray, codes: int) -> np.ndarray:
    """Centres from the spread of the points along their main direction, then moved to the means."""
    centred = points - points.mean(0)
    _, direction = np.linalg.eigh(centred.T @ centred) if points.shape[1] else (None, np.zeros((0, 0)))
    order = np.argsort(centred @ direction[:, -1], kind="stable") if points.shape[1] else np.arange(len(points))
    centres = np.array([points[part].mean(0) for part in np.array_split(order, min(codes, len(points)))])
    for _ in range(FIT_STEPS):
        code, _ = nearest(points, centres)
        held = np.bincount(code, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, code, points)
        centres[held > 0] = sums[held > 0] / held[held > 0, None]
    return centres


def fitted(rows: DataFrame, codes: int = CODES, sample: int = SAMPLE) -> Books:
    """Both codebooks, from the ``sample`` rows that a hash puts first."""
    drawn = rows.orderBy(F.xxhash64("row"), "row").limit(sample).select("v").toArrow()
    first, second = halves(matrix(drawn.column("v")))
    return codebook(first, codes), codebook(second, codes)


def placed(rows: DataFrame, books: Books) -> DataFrame:
    """The rows with their two codes and the distances from them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = [nearest(half, book) for half, book in zip(halves(matrix(batch.column("v"))), books)]
                more = [pa.array(np.asarray(x)) for code, far in found for x in (code, far)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "code1", "far1", "code2", "far2"])

    return rows.mapInArrow(work, "row long, vec_id long, label long, v array<double>, code1 long, far1 double, code2 long, far2 double")


class MultiIndex:
    """What an anchor needs to know of the cells: centres, radii, and how many rows each cell holds."""

    def __init__(self, books: Books, radii: list[np.ndarray], held: np.ndarray):
        self.books, self.radii, self.held = books, radii, held
        self.slices = -(-held // SLICE)

    def half_bounds(self, anchor: np.ndarray) -> list[np.ndarray]:
        out = []
        for half, book, radius in zip(halves(anchor[None]), self.books, self.radii):
            bound = book @ half[0] + np.sqrt((half[0] ** 2).sum()) * radius
            # room for the rounding of the sums above
            out.append(bound + 1e-9 * (np.abs(book) @ np.abs(half[0]) + np.abs(bound)) + 1e-6)
        return out

    def walk(self, anchor: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """(bound, code, code) of the cells with rows, by falling bound."""
        bounds = self.half_bounds(anchor)
        a, b = (np.argsort(-x, kind="stable") for x in bounds)
        heap = [(-(bounds[0][a[0]] + bounds[1][b[0]]), 0, 0)]
        while heap:
            bound, i, j = heapq.heappop(heap)
            if self.held[a[i], b[j]]:
                yield -bound, int(a[i]), int(b[j])
            # a cell enters behind its left neighbour, those of the first column behind the one above
            if j + 1 < len(b):
                heapq.heappush(heap, (-(bounds[0][a[i]] + bounds[1][b[j + 1]]), i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (-(bounds[0][a[i + 1]] + bounds[1][b[0]]), i + 1, 0))

    def next_cells(self, anchor: np.ndarray, seen: int, rows: int, least: float) -> tuple[list[tuple[int, int]], float]:
        """Further cells with about so many rows, and the bound of the first one left out (-inf: none).

        Cells with a bound below ``least`` are never needed.
        """
        cells, n = [], 0
        for number, (bound, i, j) in enumerate(self.walk(anchor)):
            if number < seen:
                continue
            if bound < least or n >= rows:
                return cells, bound
            cells.append((i, j))
            n += int(self.held[i, j])
        return cells, -np.inf


def built(rows: DataFrame) -> tuple[MultiIndex, DataFrame]:
    """The index and the stored rows with their cell; ``code1`` and ``code2`` name it."""
    books = fitted(rows)
    cells = stored(placed(rows, books), "index-rows")
    radii = []
    for code, far, book in (("code1", "far1", books[0]), ("code2", "far2", books[1])):
        radius = np.zeros(len(book))
        for row in cells.groupBy(code).agg(F.max(far).alias("far")).collect():  # a row per code
            radius[row[code]] = row["far"]
        radii.append(radius)
    held = np.zeros((len(books[0]), len(books[1])), np.int64)
    for row in cells.groupBy("code1", "code2").count().collect():  # a row per cell
        held[row["code1"], row["code2"]] = row["count"]
    return MultiIndex(books, radii, held), cells.select("row", "vec_id", "label", "v", "code1", "code2")


def sliced(cells: DataFrame, index: MultiIndex, chunks: int) -> DataFrame:
    """The rows under the keys of their tasks: cell, slice of the cell, chunk of anchors."""
    spark = cells.sparkSession
    size = spark.createDataFrame(
        [(i, j, int(n)) for (i, j), n in np.ndenumerate(index.slices)], "code1 long, code2 long, slices long"
    )  # at most CODES * CODES rows
    return (
        cells.join(F.broadcast(size), ["code1", "code2"])
        .withColumn("slice", F.pmod(F.xxhash64("row"), F.col("slices")))
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
        .drop("slices")
    )


def asked(anchors: DataFrame, index: MultiIndex, rows: int) -> DataFrame:
    """Anchors with their next ``cells``, ``next`` (the bound of the one after) and ``seen`` counted up.

    ``anchors`` has v, seen and least; all other columns stay.
    """
    layout = [f for f in anchors.schema.fields if f.name not in ("cells", "next")]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in layout)
    names = [f.name for f in layout]
    shared = anchors.sparkSession.sparkContext.broadcast(index)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {name: batch.column(name) for name in names}
            found = [
                shared.value.next_cells(v, seen, rows, least)
                for v, seen, least in zip(matrix(batch.column("v")), columns["seen"].to_pylist(), columns["least"].to_pylist())
            ]
            slices = shared.value.slices
            columns["seen"] = pa.array([seen + len(c) for seen, (c, _) in zip(columns["seen"].to_pylist(), found)], pa.int64())
            cells = [[{"code1": i, "code2": j, "slice": s} for i, j in c for s in range(int(slices[i, j]))] for c, _ in found]
            kind = pa.list_(pa.struct([("code1", pa.int64()), ("code2", pa.int64()), ("slice", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [*columns.values(), pa.array(cells, kind), pa.array([b for _, b in found], pa.float64())], [*names, "cells", "next"]
            )

    return anchors.mapInArrow(work, kinds + ", cells array<struct<code1: long, code2: long, slice: long>>, next double")


def products(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Inner products as whole numbers, a row per anchor; exact."""
    most = (np.abs(rows).max(initial=0.0) or 1.0) * (np.abs(anchors).max(initial=0.0) or 1.0) * max(1, rows.shape[1])
    if most < 2.0**53:
        return (anchors @ rows.T).astype(np.int64)
    whole = np.array([[int(x) for x in v] for v in rows], object).reshape(rows.shape)
    wanted = np.array([[int(x) for x in v] for v in anchors], object).reshape(anchors.shape)
    return wanted.dot(whole.T).astype(np.int64)  # an error if one does not fit


def best(owner: np.ndarray, score: np.ndarray, ids: np.ndarray, missing: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k of each owner by score, then id."""
    order = np.lexsort((row, ids, missing, -score, owner))
    owner = owner[order]
    first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else np.zeros(0, np.int64)
    rank = np.arange(len(owner)) - np.repeat(first, np.diff(np.append(first, len(owner))))
    return order[rank < k]


HITS = "anchor long, window int, row long, vec_id long, score long"


def meetings(cells: DataFrame, index: MultiIndex, asking: DataFrame, chunks: int, k: int, same: bool) -> DataFrame:
    """The first k rows of each slice for each window of the asking anchors; see ``HITS``.

    ``asking`` has anchor (a row number), label, v, windows (low, high, least:
    the lowest score still needed) and cells.
    """
    ways = asking.select("anchor", F.col("label"), "v", "windows", "chunk", F.explode("cells").alias("cell")).select(
        F.col("cell.code1").alias("to1"), F.col("cell.code2").alias("to2"), F.col("cell.slice").alias("to_slice"),
        F.col("chunk").alias("to_chunk"), "anchor", "label", "v", "windows",
    )
    names = [part.split()[0] for part in HITS.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def meet(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found: list[list[np.ndarray]] = []
        if rows.num_rows and anchors.num_rows:
            vectors, wanted = matrix(rows.column("v")), matrix(anchors.column("v"))
            row, label = (rows.column(c).to_numpy() for c in ("row", "label"))
            ids, missing = rows.column("vec_id").fill_null(0).to_numpy(), rows.column("vec_id").is_null().to_numpy().astype(bool)
            anchor, own = (anchors.column(c).to_numpy() for c in ("anchor", "label"))
            windows = anchors.column("windows").to_pylist()
            step = max(1, SCORES // len(row))
            for at in range(0, len(anchor), step):
                scores = products(vectors, wanted[at : at + step])
                here = windows[at : at + step]
                alike = own[at : at + step, None] == label[None]
                fits = alike & (anchor[at : at + step, None] != row[None]) if same else ~alike
                for number in range(max(map(len, here), default=0)):
                    none = {"low": 1, "high": 0, "least": 0}
                    these = [w[number] if number < len(w) else none for w in here]
                    low = np.array([max(w["low"], w["least"]) if w["low"] <= w["high"] else w["low"] for w in these], np.int64)
                    high = np.array([w["high"] for w in these], np.int64)
                    who, which = np.nonzero(fits & (scores >= low[:, None]) & (scores <= high[:, None]))
                    score = scores[who, which]
                    first = best(who, score, ids[which], missing[which], row[which], k)
                    who, which = who[first], which[first]
                    found.append([anchor[at + who], np.full(len(who), number, np.int32), row[which], which, score[first]])
        if not found:
            return pa.table([pa.array([], kind) for kind in kinds], names)
        anchor, window, row, which, score = map(np.concatenate, zip(*found))
        return pa.table([pa.array(anchor), pa.array(window), pa.array(row), rows.column("vec_id").take(pa.array(which)), pa.array(score)], names)

    # at most as many rows as there are cells
    wanted_cells = ways.select(F.col("to1").alias("code1"), F.col("to2").alias("code2")).distinct()
    near = cells.join(F.broadcast(wanted_cells), ["code1", "code2"], "left_semi")
    left = sliced(near, index, chunks).groupBy("code1", "code2", "slice", "chunk")
    return left.cogroup(ways.groupBy("to1", "to2", "to_slice", "to_chunk")).applyInArrow(meet, HITS)


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    """The first k of each anchor and window, with their rank from 1."""
    order = [F.desc("score"), F.asc_nulls_last("vec_id"), "row"]
    rank = F.row_number().over(Window.partitionBy("anchor", "window").orderBy(*order))
    return hits.withColumn("rank", rank).filter(F.col("rank") <= k)


WINDOW = "struct<low: long, high: long, least: long>"
_LOWEST, _HIGHEST = -(1 << 63), (1 << 63) - 1


def searched(cells: DataFrame, index: MultiIndex, anchors: DataFrame, chunks: int, k: int, same: bool) -> DataFrame:
    """The first k rows of each window of each anchor, exactly; see ``HITS``.

    ``anchors`` has anchor, label, v, chunk and windows.
    """
    pending = anchors.withColumn("seen", F.lit(0).cast("long"))
    found, ask = None, FIRST
    while True:
        # a window needs a score no lower than its low end and, once its list is full, than the last of it
        needs = F.array_min(F.transform("windows", lambda w: F.when(w["low"] <= w["high"], F.greatest(w["low"], w["least"])).otherwise(_HIGHEST)))
        asking = stored(asked(pending.withColumn("least", needs.cast("double")), index, ask), "asking-anchors")
        more = meetings(cells, index, asking, chunks, k, same)
        found = stored(_ranked(found.unionByName(more) if found else more, k).drop("rank"), "hits")
        # the score of the last one of a full list
        full = found.groupBy("anchor", "window").agg(F.count("*").alias("n"), F.min("score").alias("last")).filter(F.col("n") >= k)
        lasts = full.groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("window", "last"))).alias("lasts"))
        risen = F.transform(
            "windows",
            lambda w, i: F.struct(
                w["low"].alias("low"), w["high"].alias("high"), F.coalesce(F.try_element_at("lasts", i), w["least"]).alias("least")
            ),
        )
        open_still = F.exists(
            "windows", lambda w: (w["low"] <= w["high"]) & (F.greatest(w["low"], w["least"]).cast("double") <= F.col("next"))
        )
        pending = asking.drop("cells", "least").join(lasts, "anchor", "left").withColumn("windows", risen.cast(f"array<{WINDOW}>")).drop("lasts")
        pending = stored(pending.filter((F.col("next") > float("-inf")) & open_still).drop("next"), "pending-anchors")
        if pending.isEmpty():
            return found
        ask *= GROWTH


def mined(
    vectors: DataFrame, anchor: Column, label: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES,
    low: int = LOW, high: int = HIGH, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows that ``anchor`` selects by ``vec_id``."""
    rows = usable(vectors, id_col, vector_col, F.col("label") if label is None else label)
    none = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if rows.isEmpty():
        return vectors.sparkSession.createDataFrame([], none)
    index, cells = built(rows)
    chosen = rows.filter(F.col("vec_id").isNotNull() & anchor)
    chunks = max(1, -(-chosen.count() // CHUNK))
    window = F.struct(F.lit(_LOWEST).alias("low"), F.lit(_HIGHEST).alias("high"), F.lit(_LOWEST).alias("least"))
    chunk = F.pmod(F.xxhash64("row"), F.lit(chunks)).cast("int").alias("chunk")
    anchors = stored(chosen.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"), "label", "v", chunk), "anchors")

    wide = anchors.drop("anchor_id").withColumn("windows", F.array(window).cast(f"array<{WINDOW}>"))
    best_rows = searched(cells, index, wide, chunks, positives, True)
    ranked = stored(
        _ranked(best_rows, positives).select("anchor", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")),
        "positives",
    )
    # low * p <= 100 * s <= high * p, in whole scores
    whole = F.col("positive_score").cast("decimal(38,0)")
    edges = F.struct(
        F.ceil(whole * low / F.lit(100).cast("decimal(3,0)")).cast("long").alias("low"),
        F.floor(whole * high / F.lit(100).cast("decimal(3,0)")).cast("long").alias("high"),
        F.lit(_LOWEST).alias("least"),
    )
    windows = ranked.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("window", edges.alias("edges")))).alias("found"))
    windows = windows.select("anchor", F.col("found.edges").cast(f"array<{WINDOW}>").alias("windows"))
    narrow = anchors.drop("anchor_id").join(windows, "anchor")
    hits = searched(cells, index, narrow, chunks, negatives, False)
    return (
        _ranked(hits, negatives)
        .join(ranked, ["anchor", "window"])
        .join(anchors.select("anchor", "anchor_id"), "anchor")
        .select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        )
    )
