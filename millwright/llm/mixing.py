"""Interleaving sources to target weights by Pfair scheduling.

The documents of a source are put in a pseudo-random order and cut into
blocks. With integer weights n of total N, block i of a source is released at
slot floor((i - 1) * N / n) and due before slot ceil(i * N / n); every slot
takes the released block that is due first. At every slot each source is then
less than one block away from its share. The schedule repeats every N slots.

No document is dropped or repeated: when a source runs out, the others go on
with the same weights among themselves in a new phase. Sources without a
weight of their own, null included, are pooled into one stream. Repeated rows
count as often as they occur; rows that agree in id and text may change
places. An empty table gives an empty result. Everything is DataFrame
functions; the driver sees one row count per stream and the schedule, whose
size the weights alone decide.
"""

from math import gcd

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millwright.llm.common import fresh, stored

BLOCK = 64
SEED = 17
#: rows that one sorting task should number
SLICE_ROWS = 20_000
#: slots that one job schedules
SLOTS = 1_000
#: rows of a schedule that is sent to every task; a longer one is joined by a shuffle
SENT_SLOTS = 100_000
POOL = ""


def period(spark: SparkSession, weights: list[int]) -> list[int]:
    """The stream of each slot of one period, earliest deadline first among the released blocks.

    Equal deadlines go to the stream listed first. One job takes a run of
    slots and hands on how many blocks of each stream are done.
    """
    total = sum(weights)
    streams = F.sequence(F.lit(0), F.lit(len(weights) - 1))
    shares = F.array(*[F.lit(n).cast("long") for n in weights])

    def due(done: Column, at: Column):
        def of(stream: Column) -> Column:
            n, taken = F.get(shares, stream), F.get(done, stream)
            released = (taken < n) & (F.floor(taken * total / n) <= at)
            return F.when(released, F.struct(F.ceil((taken + 1) * total / n).alias("due"), stream.alias("stream")))

        return of

    def step(state: Column, at: Column) -> Column:
        chosen = F.array_min(F.transform(streams, due(state["done"], at)))["stream"]
        done = F.transform(state["done"], lambda n, i: n + F.when(i == chosen, 1).otherwise(0))
        return F.struct(done.alias("done"), F.concat(state["taken"], F.array(chosen)).alias("taken"))

    order, done = [], [0] * len(weights)
    for first in range(0, total, SLOTS):
        start = F.struct(
            F.array(*[F.lit(n).cast("long") for n in done]).alias("done"), F.array().cast("array<int>").alias("taken")
        )
        run = F.sequence(F.lit(first).cast("long"), F.lit(min(total, first + SLOTS) - 1).cast("long"))
        row = spark.range(1).select(F.aggregate(run, start, step).alias("state")).first()["state"]
        order, done = order + row["taken"], row["done"]
    return order


def schedule(spark: SparkSession, blocks: dict[str, int], weights: dict[str, int]) -> tuple[list, list]:
    """Phases (phase, stream, first block, last block, first slot, weight, period) and slots (phase, stream, turn, slot).

    Numbers begin at 0; ``turn`` counts a stream's blocks within a period.
    """
    left = {name: n for name, n in blocks.items() if n}
    taken = dict.fromkeys(left, 0)
    phases, slots, start = [], [], 0
    while left:
        names = sorted(left)
        factor = gcd(*[weights[name] for name in names])
        shares = [weights[name] // factor for name in names]
        total = sum(shares)
        order = period(spark, shares)
        places = {name: [at for at, stream in enumerate(order) if stream == i] for i, name in enumerate(names)}
        last = {
            name: (left[name] - 1) // share * total + places[name][(left[name] - 1) % share] + 1
            for name, share in zip(names, shares)
        }
        length = min(last.values())
        number = len({phase[0] for phase in phases})
        for name, share in zip(names, shares):
            done = length // total * share + sum(at < length % total for at in places[name])
            slots += [(number, name, turn, at) for turn, at in enumerate(places[name])]
            phases.append((number, name, taken[name], taken[name] + done - 1, start, share, total))
            taken[name] += done
            left[name] -= done
        left = {name: n for name, n in left.items() if n}
        start += length
    return phases, slots


def mixed(
    docs: DataFrame, weights: dict[str, int], pool: int = 1, block: int = BLOCK, seed: int = SEED, source_col: str = "source"
) -> DataFrame:
    """``docs`` with ``stream``, ``block``, ``slot`` and ``place`` (the row's place in its block).

    A column of ``docs`` keeps its values; where it has one of these names, the
    mixture's column gets a number (``slot_1``).

    Ordering by (slot, place) is the mixture. Numbering a stream's rows needs
    no single task: rows fall into slices by their draw, slices are numbered
    side by side, and only the counts per slice are summed up in order.
    """
    if any(not isinstance(n, int) or n < 1 for n in [*weights.values(), pool]):
        raise ValueError("weights are positive integers")
    spark = docs.sparkSession
    own = {name: f"_c{n}" for n, name in enumerate(docs.columns)}
    result = [F.col(kept).alias(name) for name, kept in own.items()]
    result += [F.col(name).alias(fresh(docs, name)) for name in ("stream", "block", "slot", "place")]
    docs = docs.toDF(*own.values())
    source, doc_id, text = own[source_col], own["doc_id"], own["text"]
    named = F.col(source).isin(list(weights)) if weights else F.lit(False)
    draw = F.xxhash64(F.lit(seed), doc_id, text)
    rows = docs.withColumns({"stream": F.when(named, F.col(source)).otherwise(F.lit(POOL)), "_draw": draw})
    totals = rows.groupBy("stream").agg(F.count("*").alias("n"))
    # at most one row per weight and the pool
    counts = {r["stream"]: r["n"] for r in totals.collect()}
    slices = max(1, -(-sum(counts.values()) // SLICE_ROWS))
    rows = rows.withColumn("_slice", F.pmod("_draw", F.lit(slices)))
    sizes = rows.groupBy("stream", "_slice").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("stream").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    begins = stored(
        sizes.select("stream", "_slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_begin")), "mixing-slices"
    )
    inside = Window.partitionBy("stream", "_slice").orderBy("_draw", doc_id)
    numbered = (
        rows.withColumn("_number", F.row_number().over(inside) - 1)
        .join(begins, ["stream", "_slice"])
        .withColumn("_number", F.col("_number") + F.col("_begin"))
    )
    phases, slots = schedule(spark, {s: -(-n // block) for s, n in counts.items()}, {**weights, POOL: pool})
    if not phases:
        none = {name: F.lit(None).cast("long") for name in ("block", "slot", "place")}
        return numbered.withColumns(none).select(*result)
    phase = spark.createDataFrame(phases, "_phase int, stream string, _first long, _last long, _start long, _share int, _period int")
    slot = spark.createDataFrame(slots, "_phase int, stream string, _turn int, _at int")
    # a phase has a row per stream
    sent = F.broadcast(slot) if len(slots) <= SENT_SLOTS else slot
    turn = F.col("block") - F.col("_first")
    return (
        numbered.withColumns({"block": F.floor(F.col("_number") / block), "place": F.col("_number") % block})
        .join(F.broadcast(phase), "stream")
        .filter(F.col("block").between(F.col("_first"), F.col("_last")))
        .withColumn("_turn", (turn % F.col("_share")).cast("int"))
        .join(sent, ["_phase", "stream", "_turn"])
        .withColumn("slot", F.col("_start") + F.floor(turn / F.col("_share")) * F.col("_period") + F.col("_at"))
        .select(*result)
    )


def report(docs: DataFrame, weights: dict[str, int], **options) -> DataFrame:
    """Per row of the mixture: doc_id, source, stream, block, slot and place."""
    rows = docs.select("doc_id", "text", "source")
    return mixed(rows, weights, **options).select("doc_id", "source", "stream", "block", "slot", "place")


def in_order(docs: DataFrame, weights: dict[str, int], partitions: int, **options) -> DataFrame:
    """``docs`` laid out in the order of the mixture, with the columns they came with.

    Written out, the files follow each other in that order.
    """
    names = [f"_c{n}" for n in range(len(docs.columns))]
    known = {"doc_id", "text", "source"}
    renamed = docs.select(*[F.col(c).alias(c if c in known else n) for c, n in zip(docs.columns, names)])
    laid = mixed(renamed, weights, **options).repartitionByRange(partitions, "slot", "place")
    ordered = laid.sortWithinPartitions("slot", "place")
    return ordered.select(*[F.col(c if c in known else n).alias(c) for c, n in zip(docs.columns, names)])
