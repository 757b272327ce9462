"""Severity of toxic language by cumulative-link ordinal regression.

A text's features are the words that occur in it and their beginnings of
four to six bytes, as sparse marks. One weight per feature is shared by all
ordered thresholds: P(grade <= k) = logistic(threshold_k - weights . marks).
The result is the expected grade. Weights are not negative, so harmless words
cannot make up for an insult, and an L1 penalty leaves few of them, so a
neutral word weighs nothing however long the text is.

Labels say toxic or not; toxic training texts are graded by how many
indicative features they hold, up to the median (grade 1) or above (grade 2).
Training uses at most ``SAMPLE`` labelled rows per class, drawn by the hash
of their id and weighted back to the size of their class; all other steps
cover all rows. The same rows choose the probability of any toxicity from
which a text is rejected, by the best F-measure.

Null and empty texts have no features. Labels that are null are ignored; if
the labels of one id differ, the highest counts. With labels of one class
only, or none, every severity is 0. Repeated rows are scored alike; an empty
table gives an empty result; further columns are ignored.
"""

from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.llm import arrays
from millwright.llm.common import bounded_batches, fresh, stored, text_struct

#: labelled rows per class that training may use
SAMPLE = 4_000
#: sampled texts a feature must occur in, and its least chi-square, and how many features training may use
LEAST_TEXTS = 4
LEAST_CHI2 = 12.0
FEATURES = 20_000
GRADES = 3
PENALTY = 0.0001
ROUNDS = 2000
BEGINNINGS = (4, 5, 6)

# lower case, and a space for every ASCII character that is no letter or digit
_FOLD = bytes(
    byte | 32 if 65 <= byte <= 90 else byte if byte >= 128 or 48 <= byte <= 57 or 97 <= byte <= 122 else 32
    for byte in range(256)
)


def marks(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text number, feature) of texts laid end to end, ordered."""
    data, begins = arrays.laid_out([text.translate(_FOLD) for text in texts])
    starts, ends = arrays.word_spans(data)
    owner = np.searchsorted(begins, starts, "right") - 1
    owners, features = [owner], [arrays.span_hashes(data, starts, ends)]
    for size in BEGINNINGS:
        long = ends - starts > size
        cut = arrays.span_hashes(data, starts[long], starts[long] + size)
        owners.append(owner[long])
        # a beginning is another feature than the word of the same letters
        features.append(arrays.mixed(cut + np.uint64(size)))
    owner, feature = np.concatenate(owners), np.concatenate(features)
    order = np.lexsort((feature, owner))
    owner, feature = owner[order], feature[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (feature[1:] != feature[:-1])
    return owner[new], feature[new]


def with_marks(docs: DataFrame) -> DataFrame:
    """Rows with the features of their text, as an array of signed longs."""

    def prepare():
        def work(texts: list[bytes]) -> dict:
            out = []
            for part in arrays.parts(texts):
                owner, feature = marks(part)
                out += np.split(feature.view(np.int64), np.searchsorted(owner, np.arange(1, len(part))))
            return {"marks": out}

        return work

    return docs.withColumn("marks", text_struct(prepare, "marks array<long>")("text")["marks"])


@dataclass(frozen=True)
class Model:
    """Feature hashes in order, their weights, the thresholds between grades, and the P(grade > 0) that rejects."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray
    reject_at: float

    def above(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for each score and threshold."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -60, 60)))


NOTHING = Model(np.zeros(0, np.uint64), np.zeros(0), np.full(GRADES - 1, 60.0), 0.5)


def fit_ordinal(
    row: np.ndarray, column: np.ndarray, grade: np.ndarray, share: np.ndarray, width: int,
    grades: int = GRADES, penalty: float = PENALTY, rounds: int = ROUNDS,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights, zero or more, and thresholds of the cumulative-link model on marks (row, column).

    Accelerated proximal gradient; ``share`` weights the rows and sums to 1.
    Thresholds are kept in order by fitting their gaps.
    """
    size = len(grade)
    weights, thresholds = np.zeros(width), np.linspace(1.0, 2.0, grades - 1)
    last, point, pace = weights.copy(), weights.copy(), 1.0
    # a row's curvature is at most a half, shared among its marks and its threshold
    held = share * (np.bincount(row, minlength=size) + 1)
    step = 2.0 / np.maximum(np.bincount(column, held[row], width), 1e-9)
    step_of_thresholds = 2.0 / float(held.sum())
    for _ in range(rounds):
        score = np.bincount(row, point[column], size)
        edges = np.concatenate([[-60.0], thresholds, [60.0]])
        high = 1 / (1 + np.exp(-np.clip(edges[grade + 1] - score, -60, 60)))
        low = 1 / (1 + np.exp(-np.clip(edges[grade] - score, -60, 60)))
        high = np.where(grade == grades - 1, 1.0, high)
        low = np.where(grade == 0, 0.0, low)
        chance = np.maximum(high - low, 1e-12)
        slope_high, slope_low = high * (1 - high), low * (1 - low)
        # derivative of the loss by the score and by each threshold
        by_score = share * (slope_high - slope_low) / chance
        by_threshold = np.bincount(grade, -share * slope_high / chance, grades)[: grades - 1]
        by_threshold = by_threshold + np.bincount(grade, share * slope_low / chance, grades)[1:]
        moved = point - step * np.bincount(column, by_score[row], width)
        weights = np.maximum(moved - step * penalty, 0)
        thresholds = np.maximum.accumulate(thresholds - step_of_thresholds * by_threshold + np.arange(grades - 1) * 1e-6)
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        point = weights + (pace - 1) / faster * (weights - last)
        last, pace = weights, faster
    return weights, thresholds


def best_cut(scores: np.ndarray, toxic: np.ndarray, share: np.ndarray) -> float:
    """The score that tells toxic from clean rows with the best F-measure, halfway to the next scores."""
    order = np.argsort(-scores, kind="stable")
    ranked, caught = scores[order], np.cumsum((share * toxic)[order])
    f_measure = 2 * caught / (np.cumsum(share[order]) + (share * toxic).sum())
    # a cut lies between two different scores
    f_measure[:-1][ranked[1:] == ranked[:-1]] = -1
    at = int(np.argmax(f_measure))
    return float((ranked[at] + ranked[min(at + 1, len(ranked) - 1)]) / 2)


def sample_labels(labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """At most ``size`` ids per class, with the number of rows each stands for."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = known.groupBy("toxic").agg(F.count("*").alias("total"))
    drawn = None
    for toxic in (0, 1):
        some = known.filter((F.col("toxic") > 0) == F.lit(bool(toxic))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)
        drawn = some if drawn is None else drawn.unionByName(some)
    return drawn.join(total, "toxic")


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on the sampled labelled rows; only selected features reach the driver."""
    bounded_batches(docs.sparkSession)
    sample = sample_labels(labels)
    # at most two times SAMPLE ids
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    rows = stored(with_marks(chosen).select("doc_id", (F.col("toxic") > 0).alias("toxic"), "total", "marks"), "toxicity-sample")
    sizes = {r["toxic"]: (r["n"], r["total"]) for r in rows.groupBy("toxic").agg(F.count("*").alias("n"), F.max("total").alias("total")).collect()}
    if len(sizes) < 2:
        return NOTHING
    n_toxic, n_clean = sizes[True][0], sizes[False][0]
    seen = rows.select("toxic", F.explode("marks").alias("mark")).groupBy("mark").agg(
        F.count_if("toxic").alias("a"), F.count_if(~F.col("toxic")).alias("b")
    )
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    n = float(n_toxic + n_clean)
    chi2 = n * (a * (n_clean - b) - b * (n_toxic - a)) ** 2 / (n_toxic * n_clean * (a + b) * (n - a - b + 1e-9))
    strong = (
        seen.filter((F.col("a") + F.col("b") >= LEAST_TEXTS) & (chi2 >= LEAST_CHI2))
        .withColumn("indicative", F.col("a") * n_clean > F.col("b") * n_toxic)
        .orderBy(chi2.desc(), "mark")
        .limit(FEATURES)
        .toPandas()
    )
    if strong.empty:
        return NOTHING
    strong = strong.assign(mark=strong["mark"].to_numpy(np.int64).view(np.uint64)).sort_values("mark")
    features, indicative = strong["mark"].to_numpy(np.uint64), strong["indicative"].to_numpy(bool)
    chosen_marks = docs.sparkSession.createDataFrame([(int(m),) for m in features.view(np.int64)], "mark long")
    pairs = (
        rows.withColumn("row", F.monotonically_increasing_id())
        .select("row", "toxic", "total", F.explode_outer("marks").alias("mark"))
        .join(F.broadcast(chosen_marks.withColumn("chosen", F.lit(True))), "mark", "left")
        .groupBy("row", "toxic", "total")
        .agg(F.collect_list(F.when(F.col("chosen"), F.col("mark"))).alias("marks"))
        .select("toxic", "total", F.array_sort("marks").alias("marks"))
        .orderBy("toxic", F.xxhash64("marks"), "marks")
        .toPandas()
    )
    counts = pairs["marks"].map(len).to_numpy()
    row = np.repeat(np.arange(len(pairs)), counts)
    column = np.searchsorted(features, np.concatenate([np.asarray(m, np.int64) for m in pairs["marks"]]).view(np.uint64))
    toxic = pairs["toxic"].to_numpy(bool)
    hits = np.bincount(row, indicative[column], len(pairs))
    grade = np.where(toxic, np.where(hits > np.median(hits[toxic]), 2, 1), 0)
    share = np.where(toxic, sizes[True][1] / n_toxic, sizes[False][1] / n_clean).astype(float)
    weights, thresholds = fit_ordinal(row, column, grade, share / share.sum(), len(features))
    scores = np.bincount(row, weights[column], len(pairs))
    used = weights != 0
    model = Model(features[used], weights[used], thresholds, 0.5)
    return replace(model, reject_at=float(model.above(np.array([best_cut(scores, toxic, share)]))[0, 0]))


def severity(model: Model, text_col: str | Column = "text") -> Column:
    """A struct (severity, grade, p_toxic, rejected): the expected grade, the likeliest one, P(grade > 0), the verdict."""

    def prepare():
        def work(texts: list[bytes]) -> dict:
            scores = []
            for part in arrays.parts(texts):
                owner, feature = marks(part)
                at = np.searchsorted(model.features, feature)
                at[at == len(model.features)] = 0
                known = model.features[at] == feature if len(model.features) else np.zeros(len(feature), bool)
                weight = model.weights[at[known]] if known.any() else np.zeros(0)
                scores.append(np.bincount(owner[known], weight, len(part)))
            above = model.above(np.concatenate(scores) if scores else np.zeros(0))
            steps = np.concatenate([np.ones((len(above), 1)), above, np.zeros((len(above), 1))], axis=1)
            return {
                "severity": np.round(above.sum(axis=1), 4),
                "grade": np.argmax(steps[:, :-1] - steps[:, 1:], axis=1),
                "p_toxic": np.round(above[:, 0], 4),
                "rejected": above[:, 0] > model.reject_at,
            }

        return work

    return text_struct(prepare, "severity double, grade int, p_toxic double, rejected boolean")(text_col)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: expected severity, likeliest grade, and whether it is rejected as toxic."""
    scored = docs.select("doc_id", severity(train(docs, labels)).alias("s"))
    return scored.select("doc_id", "s.severity", "s.grade", "s.rejected")


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows not rejected, with the columns they came with."""
    mark = fresh(docs, "_severity")
    scored = docs.withColumn(mark, severity(train(docs, labels)))
    return scored.filter(~F.col(f"{mark}.rejected")).drop(mark)
