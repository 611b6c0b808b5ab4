"""Toxicity categories by a chain of linear classifiers.

Categories are predicted one after the other; each model sees the words of a
document and the probabilities of all earlier categories. The probabilities a
later model is trained with are out-of-fold: each comes from a model that has
not seen its row, so the later model learns how far an earlier one can be
trusted.

The chain is fitted on a bounded sample of the labelled rows (``MAX_LABELLED``,
chosen by a hash of the id), of which rare labels get as many rows as frequent
ones; rows weigh what they stand for. A category takes one round: the model of
all folds and the models that leave one out are trained side by side, each by a
task that holds the sample as a sparse matrix. Words are hashed, so every word
counts, however rare. Every document is scored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.session import written

# The expected size of the sample of labelled rows.
MAX_LABELLED = 20_000
FOLDS = 3
# Words are hashed to two to this power places.
HASH_BITS = 20
# The L1 penalty on a word, in documents, is this times the root of the documents
# that the sample stands for: chance associations of a word grow like that root.
EVIDENCE = 0.06
# Steps of a fit at most, remembered steps, and the relative gain that ends it.
STEPS, REMEMBERED, ENOUGH = 80, 8, 1e-6
HASH_RANGE = 1_000_000
# Categories in chain order, made of the columns of the labels table.
CATEGORIES = ("toxic", "low_quality", "toxic_low_quality")


def words_of(text: Column) -> Column:
    """Lower-case runs of letters; none for NULL."""
    found = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}]+")
    return F.array_remove(found, "")


def hashed_words(text: Column) -> Column:
    """The places of the distinct words of a text."""
    places = F.transform(
        F.array_distinct(words_of(text)), lambda w: F.pmod(F.xxhash64(w), F.lit(1 << HASH_BITS)).cast("int")
    )
    return F.array_distinct(places)


def probability(category: str) -> str:
    return f"p_{category}"


@dataclass
class Linear:
    """A logistic model over hashed words and the probabilities of earlier categories."""

    intercept: float
    earlier: np.ndarray
    words: np.ndarray

    def packed(self) -> bytes:
        """Only the places in use."""
        used = np.flatnonzero(self.words)
        head = np.array([self.intercept, len(self.earlier), *self.earlier])
        return head.tobytes() + self.words[used].tobytes() + used.astype(np.float64).tobytes()

    @staticmethod
    def unpacked(data: bytes) -> Linear:
        values = np.frombuffer(data)
        n = int(values[1])
        weights, used = np.split(values[2 + n :], 2)
        words = np.zeros(1 << HASH_BITS)
        words[used.astype(np.int64)] = weights
        return Linear(float(values[0]), values[2 : 2 + n], words)

    def probabilities(self, rows: Sparse, earlier: np.ndarray) -> np.ndarray:
        z = self.intercept + rows.times(self.words[rows.places]) + earlier @ self.earlier
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


@dataclass
class Sparse:
    """Rows of places that hold a one."""

    places: np.ndarray
    row: np.ndarray
    n: int

    @staticmethod
    def of(lists: pa.Array) -> Sparse:
        sizes = np.diff(lists.offsets.to_numpy())
        places = lists.flatten().to_numpy(zero_copy_only=False)
        return Sparse(places, np.repeat(np.arange(len(lists)), sizes), len(lists))

    def times(self, values: np.ndarray) -> np.ndarray:
        """Sums per row of one value for each entry."""
        return np.bincount(self.row, values, self.n)

    def only(self, keep: np.ndarray) -> Sparse:
        entries = keep[self.row]
        number = np.cumsum(keep) - 1
        return Sparse(self.places[entries], number[self.row[entries]], int(keep.sum()))


def fit_linear(rows: Sparse, earlier: np.ndarray, label: np.ndarray, weight: np.ndarray) -> Linear:
    """Minimum of the weighted logistic loss plus a penalty on the absolute weights."""
    used, column = np.unique(rows.places, return_inverse=True)
    m, e = len(used), earlier.shape[1]
    sign = 2.0 * label - 1.0

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        z = x[0] + earlier @ x[1 : 1 + e] + rows.times(x[1 + e :][column])
        margin = sign * z
        share = -sign * weight / (1 + np.exp(np.clip(margin, -500, 500)))
        slope = np.concatenate([[share.sum()], share @ earlier, np.bincount(column, share[rows.row], m)])
        return float((weight * np.logaddexp(0, -margin)).sum()), slope

    penalty = np.full(1 + e + m, EVIDENCE * np.sqrt(weight.sum()))
    penalty[0] = 0.0
    x = minimised(loss, np.zeros(1 + e + m), penalty)
    words = np.zeros(1 << HASH_BITS)
    words[used] = x[1 + e :]
    return Linear(float(x[0]), x[1 : 1 + e], words)


def minimised(
    loss: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, penalty: np.ndarray
) -> np.ndarray:
    """Minimum of a convex loss plus ``penalty * |x|`` by an orthant-wise quasi-Newton method."""
    value, slope = loss(x)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(STEPS):
        up, down = slope + penalty, slope - penalty
        # The slope of the penalised loss; zero where neither side descends.
        steep = np.where(x > 0, up, np.where(x < 0, down, np.where(up < 0, up, np.where(down > 0, down, 0.0))))
        if not steep.any():
            break
        way, kept = -steep, []
        for moved, turned in reversed(steps):
            a = (moved @ way) / (moved @ turned)
            way = way - a * turned
            kept.append(a)
        if steps:
            moved, turned = steps[-1]
            way *= (moved @ turned) / (turned @ turned)
        for (moved, turned), a in zip(steps, reversed(kept)):
            way += (a - (turned @ way) / (moved @ turned)) * moved
        way[way * steep >= 0] = 0.0
        if not way.any():
            way = -steep
        side = np.where(x != 0, np.sign(x), -np.sign(steep))
        before = value + penalty @ np.abs(x)
        size = 1.0 if steps else 1.0 / max(1.0, float(np.linalg.norm(steep)))
        while True:
            to = x + size * way
            to[to * side < 0] = 0.0
            to_value, to_slope = loss(to)
            after = to_value + penalty @ np.abs(to)
            if after <= before + 1e-4 * (steep @ (to - x)) or size < 1e-12:
                break
            size /= 2
        moved, turned = to - x, to_slope - slope
        if moved @ turned > 1e-12 * (turned @ turned):
            steps = [*steps, (moved, turned)][-REMEMBERED:]
        x, value, slope = to, to_value, to_slope
        if before - after <= ENOUGH * max(1.0, abs(before)):
            break
    return x


@dataclass
class Chain:
    categories: tuple[str, ...]
    models: list[Linear]


def _numbers(table: pa.Table, names: list[str]) -> np.ndarray:
    columns = [table.column(n).to_numpy().astype(float) for n in names]
    return np.stack(columns, axis=1) if names else np.zeros((table.num_rows, 0))


def _lists(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    """One array whose offsets start at its first entry."""
    return pa.concat_arrays(column.chunks if isinstance(column, pa.ChunkedArray) else [column])


def _train_round(data: DataFrame, category: str, earlier: list[str], parts: list[int], folds: int) -> DataFrame:
    """``part, row, p, model``: a model per part, and what it gives the fold it left out.

    Part f leaves out fold f; part ``folds`` leaves out none. Each part is a
    task that gets the whole sample, whose size is bounded.
    """

    def train(table: pa.Table) -> pa.Table:
        table = table.sort_by("row")  # the same sums, whatever the order of arrival
        part = table.column("part")[0].as_py()
        rows, given = Sparse.of(_lists(table.column("words"))), _numbers(table, earlier)
        label, weight, fold = _numbers(table, [category, "weight", "fold"]).T
        seen = fold != part
        if not seen.any():  # a sample too small for folds learns from what there is
            seen[:] = True
        model = fit_linear(rows.only(seen), given[seen], label[seen], weight[seen])
        out = fold == part
        ids = table.column("row").to_numpy()[out]
        p = model.probabilities(rows, given)[out]
        return pa.table(
            {
                "part": pa.array([part] * (len(ids) + 1), pa.int32()),
                "row": pa.array([None, *ids.tolist()], pa.int64()),
                "p": pa.array([None, *p.tolist()], pa.float64()),
                "model": pa.array([model.packed()] + [None] * len(ids), pa.binary()),
            }
        )

    copies = data.withColumn("part", F.explode(F.array(*map(F.lit, parts))))
    spread = copies.repartitionByRange(len(parts), "part")
    return written(spread.groupBy("part").applyInArrow(train, "part int, row bigint, p double, model binary"))


def fit(rows: DataFrame, categories: tuple[str, ...], folds: int = FOLDS) -> Chain | None:
    """Chain over rows ``id, text, <categories>`` (0 or 1); None if there are no words.

    Ids are different. A column ``weight`` says how many rows a row stands for,
    else it is one.
    """
    weight = F.col("weight") if "weight" in rows.columns else F.lit(1.0)
    data = written(
        rows.select(
            F.col("id").cast("bigint").alias("row"),
            F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(folds)).cast("int").alias("fold"),
            hashed_words(F.col("text")).alias("words"),
            weight.cast("double").alias("weight"),
            *[F.col(c).cast("double").alias(c) for c in categories],
        )
    )
    if data.filter(F.size("words") > 0).isEmpty():
        return None
    models, earlier = [], []
    for category in categories:
        last = category == categories[-1]
        found = _train_round(data, category, earlier, [folds] if last else list(range(folds + 1)), folds)
        (whole,) = found.filter((F.col("part") == folds) & F.col("model").isNotNull()).collect()
        models.append(Linear.unpacked(bytes(whole.model)))
        if not last:
            left_out = found.filter(F.col("row").isNotNull())
            left_out = left_out.select("row", F.col("p").alias(probability(category)))
            data = data.join(left_out, "row")
            earlier.append(probability(category))
    return Chain(categories, models)


def predict(
    docs: DataFrame,
    chain: Chain | None,
    id_col: str = "doc_id",
    text_col: str = "text",
    categories: tuple[str, ...] = CATEGORIES,
) -> DataFrame:
    """``id_col``, per category ``p_<category>`` and whether it is over a half.

    One row per row of ``docs``; NULL texts and texts without words are judged
    by the models' base rates. Without a chain every probability is 0.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), hashed_words(F.col(text_col)).alias("words"))
    if chain is None:
        scored = rows.select("id", *[F.lit(0.0).alias(probability(c)) for c in categories])
    else:
        categories = chain.categories
        shared = docs.sparkSession.sparkContext.broadcast(chain.models)  # of fixed size

        def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                words = Sparse.of(_lists(batch.column(1)))
                given = np.zeros((batch.num_rows, 0))
                for model in shared.value:
                    found = model.probabilities(words, given)
                    given = np.concatenate([given, found[:, None]], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *[pa.array(p) for p in given.T]],
                    names=["id", *map(probability, categories)],
                )

        schema = ", ".join(["id bigint", *[f"{probability(c)} double" for c in categories]])
        scored = rows.mapInArrow(score, schema)
    return scored.select(
        F.col("id").alias(id_col),
        *[F.col(probability(c)) for c in categories],
        *[(F.col(probability(c)) > 0.5).alias(c) for c in categories],
    )


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """``id, text`` and the categories of about ``most`` labelled documents, or all.

    Several labels of a document add up: it is toxic if one says so, and of low
    quality if one says so. Rows with a NULL in them say nothing. Of several
    texts of one id the smallest is taken.
    """
    known = labels.select("doc_id", "quality", "toxic").dropna()
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    left, share = most, F.lit(1.0)
    strata = sorted(known.groupBy("quality", "toxic").count().collect(), key=lambda r: r["count"])
    for n, r in enumerate(strata):  # a row per pair of labels, the rarest first
        taken = min(r["count"], left // (len(strata) - n))
        left -= taken
        own = (F.col("quality") == r.quality) & (F.col("toxic") == r.toxic)
        share = F.when(own, F.lit(taken / r["count"])).otherwise(share)
    chosen = F.pmod(F.xxhash64("doc_id"), F.lit(HASH_RANGE)) < F.col("share") * HASH_RANGE
    sample = known.withColumn("share", share).filter(chosen)
    # The sample's size is bounded, so it is sent to the tasks and no other text is shuffled.
    found = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    found = found.groupBy("doc_id", "quality", "toxic", "share").agg(F.min("text").alias("text"))
    return found.select(
        F.col("doc_id").alias("id"),
        "text",
        (1 / F.col("share")).alias("weight"),
        "toxic",
        (1 - F.col("quality")).alias("low_quality"),
        (F.col("toxic") * (1 - F.col("quality"))).alias("toxic_low_quality"),
    )


def judge_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, probabilities and flags: all documents judged by a chain learned from the labels.

    One row per row of ``docs``; rows of one id are judged by their own texts.
    NULL and empty texts get the base rates, and an empty table gives an empty
    result. Without usable labels nothing is flagged. Other columns are not
    read, whatever their names.
    """
    return predict(docs, fit(labelled_sample(docs, labels), CATEGORIES))
