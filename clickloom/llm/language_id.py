"""Language identification with Kneser-Ney character models.

One interpolated Kneser-Ney four-gram model per language over the letters of a
text; everything else counts as a blank. The language with the lowest
cross-entropy per letter wins. The cross-entropy that a model has on text left
out of its counts, and its spread per letter, calibrate the rejection: a text
whose best cross-entropy lies far above, more than chance explains for its
length, is in none of the languages. The left-out text is a fold of the training
texts, scored with the counts of the others; copies are in one fold and have one
vote together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm import char_models
from clickloom.llm.char_models import BLANK, Model, letters_only, symbols, text_costs

UNKNOWN = "und"
# Rejection: share above the left-out cross-entropy, and deviations of chance.
SLACK, DEVIATIONS = 0.6, 6.0
# Folds of the training texts for the calibration.
FOLDS = 2
# Letters that a text counts for at most when its confidence is computed.
CONFIDENT_LETTERS = 50


def train_languages(rows: DataFrame, lang: Column, text: Column) -> Model:
    """Models from the rows whose language and text are not NULL, with their calibration."""
    seen = rows.select(lang.cast("string").alias("cls"), text.alias("text")).dropna()
    model, others = char_models.train_folds(seen, letters_only, FOLDS)
    if not model.classes:
        return model
    votes = left_out_entropies(seen, others).groupBy("cls", "fold", "key").agg(
        F.avg("entropy").alias("entropy"), F.avg("square").alias("square")
    )
    found = votes.groupBy("cls", "fold").agg(F.avg("entropy").alias("mean"), F.avg("square").alias("square"))
    model.mean = np.full(len(model.classes), np.nan)
    model.spread = np.zeros(len(model.classes))
    # Copies that weigh on the whole model are in the counts of all folds but
    # their own, so the fold with the highest cross-entropy tells what they do.
    for r in found.orderBy("mean").collect():  # a row per class and fold
        at = model.classes.index(r.cls)
        model.mean[at], model.spread[at] = r["mean"], np.sqrt(max(r["square"] - r["mean"] ** 2, 0.0))
    return model


def left_out_entropies(
    rows: DataFrame, others: Model, symbol_table: Callable[[], np.ndarray] = letters_only, folds: int = FOLDS
) -> DataFrame:
    """``cls, fold, key, entropy, square`` of each text with symbols under the other folds' counts.

    ``others`` is the second of :func:`char_models.train_folds`. Texts without
    another fold are left out.
    """
    shared = rows.sparkSession.sparkContext.broadcast(others)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, models = symbol_table(), {k: shared.value.columns({k: k}) for k in shared.value.classes}
        for batch in char_models.in_pieces(batches):
            texts: dict[tuple[str, int], list[tuple[int, np.ndarray]]] = {}
            for cls, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                taken = symbols(text, table)
                key = char_models.text_key(taken)
                fold = char_models.fold_of(key, folds)
                if len(taken) and f"{fold}:{cls}" in models:
                    texts.setdefault((cls, fold), []).append((key, taken))
            for (cls, fold), found in texts.items():
                keys, taken = zip(*found)
                lengths = np.array([len(t) for t in taken])
                cost, square = (text_costs(models[f"{fold}:{cls}"], list(taken), k)[:, 0] for k in (1, 2))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([cls] * len(keys), pa.string()),
                        pa.array([fold] * len(keys), pa.int32()),
                        pa.array(np.array(keys, np.uint64).view(np.int64)),
                        pa.array(cost / lengths),
                        pa.array(square / lengths),
                    ],
                    names=["cls", "fold", "key", "entropy", "square"],
                )

    return rows.mapInArrow(score, "cls string, fold int, key bigint, entropy double, square double")


def judge(model: Model, found: list[np.ndarray]) -> list[tuple[str, float, float | None, bool]]:
    """``language, confidence, cross-entropy, rejected`` of each text."""
    costs = text_costs(model, found)
    out = []
    for text, cost in zip(found, costs):
        letters = int((text != BLANK).sum())
        if not letters or not model.classes:
            out.append((UNKNOWN, 0.0, None, True))
            continue
        entropy = cost / len(text)
        best = int(np.argmin(entropy))  # ties: the first language by name
        weights = np.exp((entropy[best] - entropy) * min(len(text), CONFIDENT_LETTERS))
        chance = DEVIATIONS * model.spread[best] / np.sqrt(len(text))
        limit = model.mean[best] * (1 + SLACK) + chance
        if np.isnan(limit):  # nothing could be left out: worse than guessing any symbol alike
            limit = -float(model.floor[best])
        excess = max(1.0, entropy[best] / limit)
        out.append(
            (
                model.classes[best],
                float(1 / weights.sum() / excess),
                float(entropy[best]),
                bool(excess > 1.0),
            )
        )
    return out


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, lang_pred, score, cross_entropy, rejected``: one row per row of ``docs``.

    Only the text is read. NULL texts and texts without a letter are ``und``
    with score 0 and rejected, and so is every text if nothing was learned.
    Repeated rows give equal rows; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = letters_only()
        for batch in char_models.in_pieces(batches):
            texts = [symbols(t or "", table) for t in batch.column(1).to_pylist()]
            lang, score, entropy, rejected = zip(*judge(shared.value, texts)) if texts else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(lang, pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array(entropy, pa.float64()),
                    pa.array(rejected, pa.bool_()),
                ],
                names=["id", "lang_pred", "score", "cross_entropy", "rejected"],
            )

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    schema = "id bigint, lang_pred string, score double, cross_entropy double, rejected boolean"
    return rows.mapInArrow(predict, schema).withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether the id's text has CRC-32 2 modulo 4; a NULL id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def learn_from_documents(docs: DataFrame) -> Model:
    """Models from the documents that are not held out."""
    seen = docs.filter(F.col("doc_id").isNotNull() & ~held_out())
    return train_languages(seen, F.col("lang"), F.col("text"))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents, all columns, whose language is not rejected.

    Every row is judged by its own text, so rows without an id and rows of a
    repeated id stay or go by themselves. Other columns, whatever their names,
    pass through. An empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(learn_from_documents(docs))
    place = docs.columns.index("text")

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = letters_only()
        for batch in char_models.in_pieces(batches):
            texts = [symbols(t or "", table) for t in batch.column(place).to_pylist()]
            kept = [not rejected for *_, rejected in judge(shared.value, texts)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
