"""Character n-gram models with interpolated Kneser-Ney smoothing.

One model per class (a language, say), all of order four. An n-gram is packed
into 64 bits, 16 per character, so its context and its suffix are shifts and
masks of it. Counting runs in the tasks that read the texts and is merged by a
shuffle on the n-gram; every probability then comes from joins of count tables
that are spread by n-gram and by context. Nothing is sampled or cut off.

For scoring, every n-gram keeps its whole key: per order a sorted array of the
n-grams seen and, beside it, one log-probability per class. The arrays are sent
to all tasks and grow with the distinct n-grams of the corpus, which the memory
of the driver and of a task must hold; nothing shares an entry or is left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.session import written

ORDER = 4
SYMBOL_BITS = 16
START = 1  # stands three times before every text
BLANK = 32
ASTRAL = 0xFFFF
# Merged n-grams that a counting task holds before it passes them on.
HELD_GRAMS = 1_000_000
# Symbols scored at a time.
SCORED_SYMBOLS = 1 << 18
# Rows taken out of a batch at a time.
TAKEN_ROWS = 500
# Symbols of the runs that a text's key is chosen from: two to this power.
RUN_DOUBLINGS = 5


def letters_only() -> np.ndarray:
    """Every 16-bit code to its lower-case letter, all else to a blank."""
    table = np.full(1 << 16, BLANK, np.uint16)
    for code in range(1 << 16):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def all_symbols() -> np.ndarray:
    """Every code to itself, digits to one digit, white space and controls to a blank."""
    table = np.arange(1 << 16).astype(np.uint16)
    for code in range(1 << 16):
        char = chr(code)
        if char.isspace() or code < BLANK:
            table[code] = BLANK
        elif char.isdigit():
            table[code] = ord("0")
    return table


def symbols(text: str, table: np.ndarray) -> np.ndarray:
    """16-bit symbols of a text, runs of blanks as one, without blanks around it."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    out = table[np.minimum(codes, 0xFFFE)]
    if len(codes) and codes.max() > 0xFFFF:
        high = codes > 0xFFFF
        letter = np.array([chr(c).isalpha() for c in codes[high].tolist()])
        out[high] = np.where(letter, ASTRAL, table[ord("*")])
    blank = out == BLANK
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    out = out[keep]
    return out[:-1] if len(out) and out[-1] == BLANK else out


def grams(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Packed four-grams ending at each symbol of each text, and texts' lengths."""
    start = np.full(ORDER - 1, START, np.uint16)
    joined = np.concatenate([part for t in texts for part in (start, t)] or [start])
    joined = joined.astype(np.uint64)
    packed = joined[ORDER - 1 :].copy()
    for back in range(1, ORDER):
        shift = np.uint64(back * SYMBOL_BITS)
        packed |= joined[ORDER - 1 - back : len(joined) - back] << shift
    lengths = np.array([len(t) for t in texts], np.int64)
    # Drop the positions that end in the start symbols of the next text.
    keep = np.ones(len(packed), bool)
    ends = np.cumsum(lengths + ORDER - 1)[:-1] - (ORDER - 1)
    for i in range(ORDER - 1):
        keep[(ends + i)[ends + i < len(packed)]] = False
    return packed[keep], lengths


def text_key(text: np.ndarray) -> int:
    """The smallest hash of the runs of 32 symbols of a text.

    Copies have one key, near copies most often too (as often as they share
    runs), other texts only if they share a passage.
    """
    odd = np.uint64(0x9E3779B97F4A7C15)
    found, factor = text.astype(np.uint64) + np.uint64(1), int(odd)
    for step in (1 << n for n in range(RUN_DOUBLINGS)):
        rest = np.zeros_like(found)
        rest[:-step] = found[step:]
        found = found + rest * np.uint64(factor)
        factor = factor * factor % (1 << 64)
    # Runs that would reach over the end count only where there is no other.
    found = found[: max(1, len(found) - (1 << RUN_DOUBLINGS) + 1)]
    found = (found ^ (found >> np.uint64(32))) * odd
    found = (found ^ (found >> np.uint64(29))) * odd
    return int((found ^ (found >> np.uint64(32))).min()) if len(found) else 0


def fold_of(key: int, folds: int) -> int:
    """The fold of a text with this key; a key is a minimum, so it is mixed first."""
    return ((key * 0xBF58476D1CE4E5B9) % (1 << 64) >> 40) % folds


def in_pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches, so that few texts are unpacked at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, TAKEN_ROWS):
            yield batch.slice(at, TAKEN_ROWS)


def count_grams(rows: DataFrame, table: Callable[[], np.ndarray], folds: int = 1) -> DataFrame:
    """``cls, fold, gram, n`` over rows ``cls, text``; NULL classes and texts count nothing.

    Copies are in the same of the ``folds``.
    """

    def merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([k for k, _ in parts])
        values, place = np.unique(keys, return_inverse=True)
        return values, np.bincount(place, np.concatenate([n for _, n in parts])).astype(np.int64)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, held = table(), {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (cls, fold), parts in held.items():
                keys, n = merge(parts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([cls] * len(keys)),
                        pa.array([fold] * len(keys), pa.int32()),
                        pa.array(keys.view(np.int64)),
                        pa.array(n),
                    ],
                    names=["cls", "fold", "gram", "n"],
                )
            held.clear()

        for batch in in_pieces(batches):
            texts: dict[tuple[str, int], list[np.ndarray]] = {}
            for cls, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                taken = symbols(text, codes)
                fold = fold_of(text_key(taken), folds) if folds > 1 else 0
                texts.setdefault((cls, fold), []).append(taken)
            for cls, found in texts.items():
                packed = grams(found)[0]
                for at in range(0, len(packed), SCORED_SYMBOLS):
                    piece = np.unique(packed[at : at + SCORED_SYMBOLS], return_counts=True)
                    held.setdefault(cls, []).append(piece)
                    if len(held[cls]) >= 8:
                        held[cls] = [merge(held[cls])]
            if sum(len(k) for parts in held.values() for k, _ in parts) > HELD_GRAMS:
                yield from flush()
        yield from flush()

    rows = rows.filter(F.col("cls").isNotNull() & F.col("text").isNotNull()).select("cls", "text")
    found = rows.mapInArrow(count, "cls string, fold int, gram bigint, n bigint")
    return found.groupBy("cls", "fold", "gram").agg(F.sum("n").alias("n"))


def _suffix(gram: Column, order: int) -> Column:
    return gram.bitwiseAND(F.lit((1 << SYMBOL_BITS * order) - 1))


def _discounts(counts: DataFrame, modified: bool) -> dict[str, list[float]]:
    """Discounts of counts one, two and more per class, from the counts of counts."""
    row = counts.groupBy("cls").agg(
        *[F.count_if(F.col("c") == k).alias(f"n{k}") for k in (1, 2, 3, 4)]
    )
    out = {}
    for r in row.collect():  # a row per class
        y = r.n1 / (r.n1 + 2 * r.n2) if r.n1 else 0.5
        found = [y, y, y]
        if modified and min(r.n1, r.n2, r.n3) > 0:
            ratios = (r.n2 / r.n1, r.n3 / r.n2, r.n4 / r.n3)
            found = [1 - 2 * y * ratios[0], 2 - 3 * y * ratios[1], 3 - 4 * y * ratios[2]]
        out[r.cls] = [min(max(d, 0.05), k - 0.05) for k, d in zip((1, 2, 3), found)]
    return out


def _choice(values: dict[str, float]) -> Column:
    pairs = [part for cls, v in values.items() for part in (F.lit(cls), F.lit(float(v)))]
    return F.element_at(F.create_map(*pairs), F.col("cls"))


@dataclass
class Model:
    """Sorted n-grams per order with log-probabilities, and back-off per context."""

    classes: list[str]
    grams: dict[int, np.ndarray] = field(default_factory=dict)
    logp: dict[int, np.ndarray] = field(default_factory=dict)
    contexts: dict[int, np.ndarray] = field(default_factory=dict)
    backoff: dict[int, np.ndarray] = field(default_factory=dict)
    floor: np.ndarray | None = None  # log-probability of an unseen symbol
    mean: np.ndarray | None = None  # cross-entropy of left-out texts, NaN without any
    spread: np.ndarray | None = None  # its deviation per symbol

    def columns(self, names: dict[str, str]) -> Model:
        """The classes that are keys of ``names``, called by its values."""
        at = [self.classes.index(k) for k in names]

        def taken(tables: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
            return {order: np.ascontiguousarray(values[:, at]) for order, values in tables.items()}

        return Model(
            list(names.values()), self.grams, taken(self.logp), self.contexts, taken(self.backoff), self.floor[at]
        )


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return at, keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)


def log_probabilities(model: Model, packed: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Rows of ln p(symbol | context), a column per class, backing off where unseen."""
    if order == 0:
        return np.broadcast_to(model.floor, (len(packed), len(model.classes)))
    at, found = _find(model.grams[order], packed)
    out = model.logp[order][at] if len(model.grams[order]) else np.zeros(
        (len(packed), len(model.classes)), np.float32
    )
    unseen = np.flatnonzero(~found)
    if len(unseen):
        rest = packed[unseen]
        lower = rest & np.uint64((1 << SYMBOL_BITS * (order - 1)) - 1)
        value = log_probabilities(model, lower, order - 1).copy()
        value += _backoff(model, rest >> np.uint64(SYMBOL_BITS), order)
        out[unseen] = value
    return out


def _backoff(model: Model, contexts: np.ndarray, order: int) -> np.ndarray:
    keys = model.contexts[order]
    out = np.zeros((len(contexts), len(model.classes)), np.float32)
    if len(keys):
        at, found = _find(keys, contexts)
        out[found] = model.backoff[order][at[found]]
    return out


def train(rows: DataFrame, table: Callable[[], np.ndarray], modified: bool = False) -> Model:
    """Model of rows ``cls, text``: all of them count.

    ``modified`` takes three discounts per order, else one. Without any text
    the model has no classes.
    """
    counts = count_grams(rows, table).drop("fold")
    return _train(written(counts), modified)


def train_folds(
    rows: DataFrame, table: Callable[[], np.ndarray], folds: int, modified: bool = False
) -> tuple[Model, Model]:
    """Model of all rows, and models that leave out one fold of the texts each.

    Class ``f:cls`` of the second has the texts of ``cls`` outside fold ``f``;
    it is missing where there are none.
    """
    counts = written(count_grams(rows, table, folds))
    # The folds add up, so every count is shuffled and joined beside the others.
    others = [F.when(F.col("fold") != f, F.lit(f"{f}:")) for f in range(folds)]
    part = F.explode(F.array_compact(F.array(F.lit("all:"), *others)))
    named = counts.select(part.alias("part"), "cls", "gram", "n").select(
        F.concat("part", "cls").alias("cls"), "gram", "n"
    )
    found = _train(written(named.groupBy("cls", "gram").agg(F.sum("n").alias("n"))), modified)
    if not found.classes:
        return found, found
    whole = {k: k[len("all:") :] for k in found.classes if k.startswith("all:")}
    return found.columns(whole), found.columns({k: k for k in found.classes if k not in whole})


def _train(counts: DataFrame, modified: bool) -> Model:
    totals = counts.groupBy("cls").agg(F.sum("n").alias("total")).collect()  # a row per class
    classes = sorted(r.cls for r in totals)
    model = Model(classes)
    if not classes:
        return model
    per_order = {ORDER: counts.withColumnRenamed("n", "c")}
    for order in range(ORDER - 1, 0, -1):
        longer = per_order[order + 1].select("cls", _suffix(F.col("gram"), order).alias("gram"))
        # Continuations: the distinct symbols seen before this n-gram.
        per_order[order] = written(
            longer.groupBy("cls", "gram").agg(F.count(F.lit(1)).alias("c"))
        )
    sizes = {r.cls: r.n + 1 for r in per_order[1].groupBy("cls").agg(F.count("*").alias("n")).collect()}
    model.floor = -np.log([float(sizes[k]) for k in classes]).astype(np.float32)
    lower: DataFrame | None = None
    for order in range(1, ORDER + 1):
        table_n = per_order[order].withColumn("ctx", F.shiftrightunsigned("gram", SYMBOL_BITS))
        cut = _discounts(table_n, modified)
        c = F.col("c")
        taken = F.when(c == 1, _choice({k: d[0] for k, d in cut.items()})).when(
            c == 2, _choice({k: d[1] for k, d in cut.items()})
        ).otherwise(_choice({k: d[2] for k, d in cut.items()}))
        table_n = table_n.withColumn("cut", F.least(taken, c.cast("double")))
        contexts = table_n.groupBy("cls", "ctx").agg(
            F.sum("c").alias("total"), F.sum("cut").alias("given")
        )
        contexts = written(contexts.withColumn("gamma", F.col("given") / F.col("total")))
        joined = table_n.join(contexts, ["cls", "ctx"]).select(
            "cls", "gram", "c", "gamma",
            ((F.col("c") - F.col("cut")) / F.col("total")).alias("alpha"),
        )
        if lower is None:
            below = _choice({k: 1.0 / n for k, n in sizes.items()})
            joined = joined.withColumn("below", below)
        else:
            shorter = lower.select("cls", F.col("gram").alias("suffix"), F.col("p").alias("below"))
            joined = joined.withColumn("suffix", _suffix(F.col("gram"), order - 1)).join(
                shorter, ["cls", "suffix"]
            )
        lower = written(
            joined.select("cls", "gram", "c", (F.col("alpha") + F.col("gamma") * F.col("below")).alias("p"))
        )
        _export(model, order, lower, contexts)
    return model


def _gathered(model: Model, table: DataFrame, key: str, value: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, class numbers and values of all rows of a table."""
    arrow = table.select("cls", key, F.col(value).cast("double").alias("value")).toArrow()
    keys = arrow.column(key).to_numpy().astype(np.int64).view(np.uint64)
    return keys, _class_numbers(model, arrow), arrow.column("value").to_numpy()


def _export(model: Model, order: int, probabilities: DataFrame, contexts: DataFrame) -> None:
    """Take all n-grams and contexts of one order."""
    ctx, column, gamma = _gathered(model, contexts, "ctx", "gamma")
    model.contexts[order], place = np.unique(ctx, return_inverse=True)
    backoff = np.zeros((len(model.contexts[order]), len(model.classes)), np.float32)
    backoff[place, column] = np.log(np.maximum(gamma, 1e-12))
    model.backoff[order] = backoff
    gram, column, p = _gathered(model, probabilities, "gram", "p")
    keys, place = np.unique(gram, return_inverse=True)
    # A class that has not seen the n-gram backs off to its shorter ones.
    suffix = keys & np.uint64((1 << SYMBOL_BITS * (order - 1)) - 1)
    values = log_probabilities(model, suffix, order - 1) + _backoff(model, keys >> np.uint64(SYMBOL_BITS), order)
    values[place, column] = np.log(p)
    model.grams[order], model.logp[order] = keys, values.astype(np.float32)


def _class_numbers(model: Model, arrow: pa.Table) -> np.ndarray:
    number = {cls: i for i, cls in enumerate(model.classes)}
    encoded = arrow.column("cls").combine_chunks().dictionary_encode()
    names = np.array([number[c] for c in encoded.dictionary.to_pylist()], np.int64)
    return names[encoded.indices.to_numpy()]


def text_costs(model: Model, texts: list[np.ndarray], power: int = 1) -> np.ndarray:
    """Sum of -ln p, to a power, over the symbols of each text, a column per class."""
    out = np.zeros((len(texts), len(model.classes)))
    if not model.classes:
        return out
    at = 0
    while at < len(texts):
        stop, held = at, 0
        while stop < len(texts) and (stop == at or held + len(texts[stop]) <= SCORED_SYMBOLS):
            held += len(texts[stop])
            stop += 1
        packed, lengths = grams(texts[at:stop])
        ends = np.cumsum(lengths)
        for piece in range(0, len(packed), SCORED_SYMBOLS):
            found = log_probabilities(model, packed[piece : piece + SCORED_SYMBOLS])
            sums = np.zeros((len(found) + 1, len(model.classes)))
            np.cumsum((-found) ** power, axis=0, dtype=np.float64, out=sums[1:])
            first = np.clip(ends - lengths - piece, 0, len(found))
            last = np.clip(ends - piece, 0, len(found))
            out[at:stop] += sums[last] - sums[first]
        at = stop
    return out
