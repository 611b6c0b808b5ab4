"""Document quality by the perplexity under a model of trusted text.

A modified Kneser-Ney character model per language is trained on all documents
whose label says good quality; its probabilities come from joins of count
tables that are spread by n-gram and context. Every document gets its
perplexity under its own language's model. The threshold of a language is a
high quantile of the perplexities that its trusted documents have under models
of the other ones.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm import char_models
from clickloom.llm.char_models import Model, all_symbols, symbols, text_costs
from clickloom.llm.language_id import left_out_entropies
from clickloom.session import written

QUANTILE = 0.995
ACCURACY = 10_000
# Folds of the trusted texts for the thresholds.
FOLDS = 2
# Bits of the filter that drops untrusted rows where they are read: 8 MB, however many ids.
FILTER_BITS = 1 << 26


def trusted_rows(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """``cls, text`` of the documents whose ``doc_id`` is in ``trusted``.

    Only what passes a filter of fixed size over the ids is shuffled for the
    exact join, which is of one kind at every size.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    ids = trusted.select("doc_id").dropna().distinct()
    filled = written(
        ids.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bitmap")
        )
    )
    rows = docs.select(
        "doc_id",
        F.col("lang").cast("string").alias("cls"),
        "text",
        F.bitmap_bucket_number(place).alias("own_bucket"),
        F.bitmap_bit_position(place).cast("int").alias("bit"),
    )
    # At most FILTER_BITS bits.
    rows = rows.join(F.broadcast(filled), F.col("own_bucket") == F.col("bucket"))
    byte = F.expr("conv(hex(substring(bitmap, bit div 8 + 1, 1)), 16, 10)").cast("int")
    found = rows.withColumn("byte", byte).filter("(shiftright(byte, bit % 8) & 1) = 1")
    found = found.select("doc_id", "cls", "text").hint("merge")
    # Every id once. A semi join would be pushed below the filter, and shuffle all rows.
    return found.join(ids, "doc_id").select("cls", "text")


def train_trusted(rows: DataFrame) -> tuple[Model, dict[str, float]]:
    """Models per ``cls`` of rows ``cls, text``, and the perplexity limit of each.

    The limit is a high quantile of the perplexities of trusted texts under the
    counts of the other fold; copies, and most near copies, have one vote
    together. A class whose texts are all in one fold has no limit.
    """
    model, others = char_models.train_folds(rows.dropna(), all_symbols, FOLDS, modified=True)
    if not model.classes:
        return model, {}
    left_out = left_out_entropies(rows.dropna(), others, all_symbols, FOLDS)
    votes = left_out.groupBy("cls", "key").agg(F.avg("entropy").alias("entropy"))
    limits = votes.groupBy("cls").agg(F.percentile_approx("entropy", QUANTILE, ACCURACY).alias("limit"))
    return model, {r.cls: float(np.exp(r.limit)) for r in limits.collect()}  # a row per class


def perplexities(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang, perplexity`` of every row of ``doc_id, lang, text``.

    A language without a model takes the model that likes the text best. A NULL
    or blank text, or no model at all, gives NULL.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, model = all_symbols(), shared.value
        number = {cls: i for i, cls in enumerate(model.classes)}
        for batch in char_models.in_pieces(batches):
            texts = [symbols(t or "", table) for t in batch.column(2).to_pylist()]
            costs = text_costs(model, texts)
            values = []
            for text, cost, lang in zip(texts, costs, batch.column(1).to_pylist()):
                if not len(text) or not model.classes:
                    values.append(None)
                    continue
                own = cost[number[lang]] if lang in number else cost.min()
                values.append(float(np.exp(min(own / len(text), 700.0))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(values, pa.float64())],
                names=["doc_id", "lang", "perplexity"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("lang").cast("string"), "text")
    return rows.mapInArrow(compute, "doc_id bigint, lang string, perplexity double")


def judge_quality(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """``doc_id, lang, perplexity, threshold, keep``: one row per row of ``docs``.

    ``trusted`` holds the ``doc_id`` of trusted documents. A language without
    a limit of its own, and a NULL language, takes the highest limit of all.
    Documents without a perplexity are not kept. Repeated rows give equal rows;
    an empty table gives an empty result, and without trusted text, or with a
    single one, nothing is kept. Other columns are not read, whatever their names.
    """
    # Counted and then scored: the join is not made twice.
    model, limits = train_trusted(written(trusted_rows(docs, trusted)))
    scores = perplexities(docs, model)
    if limits:
        pairs = [part for lang, limit in limits.items() for part in (F.lit(lang), F.lit(limit))]
        own = F.element_at(F.create_map(*pairs), F.col("lang"))
        threshold = F.coalesce(own, F.lit(max(limits.values())))
    else:
        threshold = F.lit(None).cast("double")
    keep = F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False))
    return scores.withColumn("threshold", threshold).withColumn("keep", keep)
