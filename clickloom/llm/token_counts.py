"""Token counts of a byte-level BPE vocabulary by the whole-token shortcut.

The library cuts a text into pre-tokens and merges each one by itself. Most
pre-tokens are vocabulary strings. Whether such a string comes out of its own
merges as one token is proved once for the whole vocabulary, on the driver
(``whole_tokens``); a pre-token among the proved ones counts one without being
merged. Only the rest is merged, and frequent ones are remembered.

The vocabulary is a fixed file of a few megabytes; its tables are what is sent
to the tasks.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import filterfalse, islice

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickloom.llm.bpe import Remembered, byte_symbols

# Fixed value: the pre-tokens of a byte-level vocabulary.
PRE_TOKENS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
# Pre-tokens looked up at a time, so that a very long text makes no list of all.
LOOKED_UP = 50_000
# Pre-tokens up to this many bytes are merged by trying all pairs again.
SHORT = 40
LIMIT = 512


@dataclass
class Tables:
    """What counting needs of a vocabulary file."""

    content: str
    special: list[str]
    byte_ids: list[int]
    # Two neighbouring ids as one number to the rank of their merge and what it makes.
    merges: dict[int, tuple[int, int]]
    size: int
    whole: frozenset[str]


def tables(content: str) -> Tables:
    """Tables of a vocabulary file, with the proof of its whole tokens."""
    data = json.loads(content)
    ids, size = data["model"]["vocab"], len(data["model"]["vocab"])
    parts = [m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"]]
    merges = {ids[a] * size + ids[b]: (rank, ids[a + b]) for rank, (a, b) in enumerate(parts)}
    symbols = byte_symbols()
    found = Tables(
        content,
        [t["content"] for t in data["added_tokens"] or []],
        [ids[s] for s in symbols],
        merges,
        size,
        frozenset(),
    )
    found.whole = whole_tokens(ids, found)
    return found


def whole_tokens(vocabulary: Iterable[str], found: Tables) -> frozenset[str]:
    """The vocabulary strings whose own merges end in one token.

    A string that is no UTF-8 text can be no pre-token and is left out.
    """
    byte_of = {s: b for b, s in enumerate(byte_symbols())}
    whole = []
    for token in vocabulary:
        data = bytes(byte_of[s] for s in token)
        if len(merged(data, found)) == 1:
            try:
                whole.append(data.decode())
            except UnicodeDecodeError:
                continue
    return frozenset(whole)


def merged(data: bytes, found: Tables) -> list[int]:
    """The tokens of one pre-token: the strongest merge first, of equal ones the left."""
    ids = [found.byte_ids[b] for b in data]
    if len(ids) > SHORT:
        return _merged_long(ids, found)
    merges, size = found.merges, found.size
    while len(ids) > 1:
        best, at = None, 0
        for i in range(len(ids) - 1):
            pair = merges.get(ids[i] * size + ids[i + 1])
            if pair is not None and (best is None or pair < best):
                best, at = pair, i
        if best is None:
            break
        ids[at : at + 2] = [best[1]]
    return ids


def _merged_long(ids: list[int], found: Tables) -> list[int]:
    """The same with a queue of the possible merges, in n log n steps."""
    merges, size, n = found.merges, found.size, len(ids)
    held, after, before = array("q", ids), array("q", range(1, n + 1)), array("q", range(-1, n - 1))
    queue: list[tuple[int, int, int]] = []

    def offer(at: int) -> None:
        right = after[at]
        if right < n and (pair := merges.get(held[at] * size + held[right])):
            heapq.heappush(queue, (pair[0], at, pair[1]))

    for i in range(n - 1):
        offer(i)
    while queue:
        rank, at, token = heapq.heappop(queue)
        right = after[at]
        # The place may have been merged away, or stand beside something else by now.
        if held[at] < 0 or right >= n or merges.get(held[at] * size + held[right]) != (rank, token):
            continue
        held[at], held[right] = token, -1
        after[at] = after[right]
        if after[at] < n:
            before[after[at]] = at
        offer(at)
        if before[at] >= 0:
            offer(before[at])
    return [i for i in held if i >= 0]


def _unsure() -> re.Pattern:
    """Characters that Unicode 3.2 did not have.

    Tables of different age may tell letters among them apart differently, so
    texts holding one are cut by the library's own pre-tokenizer.
    """
    old = unicodedata.ucd_3_2_0.category
    ranges, first = [], None
    for code in range(sys.maxunicode + 2):
        new = code <= sys.maxunicode and old(chr(code)) == "Cn"
        if new and first is None:
            first = code
        elif not new and first is not None:
            ranges.append(f"\\U{first:08x}-\\U{code - 1:08x}")
            first = None
    return re.compile(f"[{''.join(ranges)}]")


class Counter:
    """Counts the tokens of texts; pre-tokens that had to be merged are remembered."""

    def __init__(self, found: Tables) -> None:
        self.found = found
        self.merged = Remembered(lambda word: len(merged(word.encode(), found)))
        self.unsure = _unsure()
        self.library = Tokenizer.from_str(found.content).pre_tokenizer
        self.special = (
            re.compile("|".join(map(re.escape, sorted(found.special, key=len, reverse=True))))
            if found.special
            else None
        )

    def pre_tokens(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens of a text in order, some at a time."""
        if not text.isascii() and self.unsure.search(text):
            words = (text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text))
        elif len(text) < LOOKED_UP:
            yield PRE_TOKENS.findall(text)
            return
        else:
            words = (m.group() for m in PRE_TOKENS.finditer(text))
        yield from iter(lambda: list(islice(words, LOOKED_UP)), [])

    def count(self, text: str) -> int:
        n, parts = 0, [text]
        if self.special:
            parts = self.special.split(text)
            n = len(parts) - 1  # every special string is one token
        whole, rest = self.found.whole.__contains__, self.merged
        for part in parts:
            for chunk in self.pre_tokens(part):
                hits = sum(map(whole, chunk))
                n += hits
                if hits < len(chunk):
                    n += sum(rest[word] for word in filterfalse(whole, chunk))
        return n

    def forget(self) -> None:
        self.merged.older = {}
        self.merged.clear()


_COUNTERS: dict[int, Counter] = {}


def count_tokens(
    docs: DataFrame, path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col, n_bytes, n_tokens, over_limit``: one row per row of ``docs``.

    Whole texts count, without any token added; special strings inside a text
    are one token each, as in the library. A NULL text counts as empty: no
    bytes, no tokens. A NULL id stays. Repeated rows give equal rows, an empty
    table an empty result; other columns are not read, whatever their names.
    """
    with open(path, encoding="utf-8") as file:  # the driver's own installation
        shared = docs.sparkSession.sparkContext.broadcast(tables(file.read()))

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(shared.value.content)
        if key not in _COUNTERS:  # this worker process serves many tasks
            _COUNTERS.clear()
            _COUNTERS[key] = Counter(shared.value)
        counter = _COUNTERS[key]
        try:
            for batch in batches:
                n = [counter.count(t.as_py()) for t in batch.column(1)]
                size = pc.cast(pc.binary_length(batch.column(1)), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), size, pa.array(n, pa.int64())], names=["id", "n_bytes", "n_tokens"]
                )
        finally:
            counter.forget()

    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    found = rows.mapInArrow(compute, "id bigint, n_bytes bigint, n_tokens bigint")
    return found.withColumn("over_limit", F.col("n_tokens") > limit).withColumnRenamed("id", id_col)
