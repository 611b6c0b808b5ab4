"""Byte-pair encoding as a streaming transducer, and incremental decoding.

A sequence of tokens is the encoding of its text exactly when every token
encodes to itself and every two neighbours encode to themselves. So each prefix
of a word has at most one sequence of tokens. The transducer reads a word from
left to right, takes the longest token that fits its predecessor, and steps
back where no token fits; a boundary from which it stepped back is never tried
again, so the work is linear. The merge list tells how far behind the input a
boundary can still be given up (``sufficient_lookahead``); tokens further back
are final, are emitted and forgotten, so a word of any length takes constant
memory.

The vocabulary file is read on the driver and sent to the tasks; it is a fixed
file of a few megabytes.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD_END = "</w>"
# Fixed value: what the vocabulary's pre-tokenizer keeps; white space goes.
PIECES = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
)
BLANKS = regex.compile(r"\p{White_Space}+")
# Python splits at these too, but they are no white space.
SEPARATORS = regex.compile("[\x1c-\x1f]")
# Words up to this many characters are kept for reuse, and this many of them.
REUSED_CHARS, REUSED_WORDS = 48, 100_000
# Remembered answers on whether two tokens can be neighbours.
REUSED_PAIRS = 200_000
# Words whose tokens are joined before they are digested.
DIGEST_WORDS = 50_000


def byte_symbols() -> list[str]:
    """One printable character for each byte: itself where it prints, else one above 255."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    named = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}
    return [named[b] for b in range(256)]


class Vocabulary:
    """Tokens, merges and special tokens of a vocabulary file with word ends."""

    def __init__(self, content: str) -> None:
        data = json.loads(content)
        model = data["model"]
        self.ids: dict[str, int] = dict(model["vocab"])
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.ranks: dict[tuple[str, str], int] = {pair: i for i, pair in enumerate(merges)}
        self.special: dict[str, int] = {t["content"]: t["id"] for t in data["added_tokens"] or []}
        self.tokens: dict[int, str] = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        self.lookahead = sufficient_lookahead(merges)
        self.longest = max(map(symbol_count, self.ids))


def symbol_count(token: str) -> int:
    return len(token.removesuffix(WORD_END)) if token != WORD_END else len(token)


def sufficient_lookahead(merges: list[tuple[str, str]]) -> int:
    """Symbols behind which no token of a merge list can still change.

    A merge is undone by later input only if an earlier, stronger merge takes
    the end of its right part, which in turn waits for its own right part, and
    so on with ever stronger merges. The longest such chain, measured in the
    symbols of its right parts, bounds what a token has to wait for.
    """
    reach: dict[str, int] = {}
    most = 1
    for left, right in merges:  # the strongest first
        waits = max((reach.get(right[i:], 0) for i in range(len(right))), default=0)
        need = symbol_count(right) + waits
        reach[left] = max(reach.get(left, 0), need)
        most = max(most, need)
    return most


class Transducer:
    """Encodes words given symbol by symbol."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        ids, n = vocabulary.ids, max(vocabulary.ids.values()) + 1
        # The merge that makes each token, and its parts; symbols have none.
        self.made, self.left, self.right = [-1] * n, list(range(n)), list(range(n))
        self.rank: dict[int, int] = {}
        for (left, right), rank in vocabulary.ranks.items():
            a, b, token = ids[left], ids[right], ids[left + right]
            self.made[token], self.left[token], self.right[token] = rank, a, b
            self.rank[a * n + b] = rank
        self.size = n
        self.pairs: dict[int, bool] = {}
        self.most_held = 0  # symbols, for tests
        # The tokens as a tree of symbols in one table: node and symbol to the
        # next node, and to the token (plus one) that ends there, if any.
        # A symbol is a byte, or a byte plus 256 at the end of a word.
        byte_of = {s: b for b, s in enumerate(byte_symbols())}
        self.tree: dict[int, int] = {}
        nodes = 1
        for token, number in ids.items():
            parts = self.symbols(token)
            if self.merged(list(parts)) != [token]:
                continue  # never made
            key, node = 0, 0
            for part in parts:
                text = part.removesuffix(WORD_END)
                key = node * 512 + byte_of[text] + 256 * (len(text) < len(part))
                if key not in self.tree:
                    self.tree[key] = nodes * 512 << 17
                    nodes += 1
                node = self.tree[key] >> 17 >> 9
            self.tree[key] |= number + 1

    def merged(self, parts: list[str]) -> list[str]:
        """Apply the merges to a few symbols, the strongest first."""
        ranks, none = self.vocabulary.ranks, 1 << 60
        while len(parts) > 1:
            found = [ranks.get(pair, none) for pair in zip(parts, parts[1:])]
            best = found.index(min(found))
            if found[best] == none:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts

    @staticmethod
    def symbols(token: str) -> list[str]:
        text = token.removesuffix(WORD_END)
        parts = list(text)
        if len(text) < len(token):
            parts[-1:] = [(parts[-1] if parts else "") + WORD_END]
        return parts

    def neighbours(self, a: int, b: int) -> bool:
        """Whether two tokens stay apart when their symbols are merged together.

        Undoes their merges from the latest on. What then touches the boundary
        from both sides must not merge before the undone merge took place; of
        equal merges the one further left is earlier.
        """
        made, rank, size, limit = self.made, self.rank, self.size, 1 << 60
        while rank.get(a * size + b, limit) >= limit:
            if made[a] < 0 and made[b] < 0:
                return True
            if made[a] > made[b]:
                limit, a = made[a], self.right[a]
            else:
                limit, b = made[b] + 1, self.left[b]
        return False

    def encode(self, word: Iterable[bytes]) -> Iterator[list[int]]:
        """Token ids of one word given in pieces of its bytes, as soon as no further symbol can change them."""
        lookahead, longest = self.vocabulary.lookahead, self.vocabulary.longest
        state = _Path()
        for piece in word:
            for at in range(0, len(piece), lookahead):
                state.held.extend(piece[at : at + lookahead])
                if len(state.held) > 2 * lookahead + longest:
                    # The last symbol waits: it may close the word.
                    self._advance(state, len(state.held) - 1 - longest)
                    self.most_held = max(self.most_held, len(state.held))
                    if done := state.take(lookahead):
                        yield done
        if state.held:
            state.held[-1] += 256
            self._advance(state, len(state.held))
            yield state.tokens[1:]

    def _advance(self, state: _Path, stop: int) -> None:
        """Find tokens up to ``stop`` or a little beyond."""
        pairs, size, tree = self.pairs, self.size, self.tree
        held, tokens, ends, options, dead = (
            state.held, state.tokens, state.ends, state.options, state.dead
        )
        n, start = len(held), ends[-1]
        while start < stop:
            if len(options) < len(ends):  # a new boundary
                found, node, end = [], 0, start
                while end < n:
                    step = tree.get(node + held[end])
                    if step is None:
                        break
                    end += 1
                    node, token = step >> 17, step & 0x1FFFF
                    if token:
                        found.append((token - 1, end))
                options.append(found)
            found, before = options[-1], tokens[-1]
            while found:
                token, end = found.pop()
                if end in dead:
                    continue
                if before >= 0:
                    key = before * size + token
                    fits = pairs.get(key)
                    if fits is None:
                        fits = self._remember(key, before, token)
                    if not fits:
                        continue
                tokens.append(token)
                ends.append(end)
                start = end
                break
            else:
                if len(ends) == 1:
                    raise ValueError(f"no token fits {held[start : start + 8]}")
                dead.add(start)
                options.pop()
                tokens.pop()
                ends.pop()
                start = ends[-1]

    def _remember(self, key: int, before: int, token: int) -> bool:
        if len(self.pairs) >= REUSED_PAIRS:
            self.pairs.clear()
        self.pairs[key] = fits = self.neighbours(before, token)
        return fits


class _Path:
    """Symbols of a word not yet emitted, and the tokens found for them so far."""

    def __init__(self) -> None:
        self.held: list[int] = []
        # The token before the held symbols (-1 at the start), then the found ones,
        # where each ends, and what else may start there.
        self.tokens, self.ends = [-1], [0]
        self.options: list[list[tuple[int, int]]] = []
        self.dead: set[int] = set()

    def take(self, lookahead: int) -> list[int]:
        """Emit and forget the tokens that end more than the lookahead behind."""
        final = self.ends[-1] - lookahead
        k = sum(end <= final for end in self.ends) - 1
        if k <= 0:
            return []
        done, cut = self.tokens[1 : k + 1], self.ends[k]
        self.tokens, self.ends = self.tokens[k:], [e - cut for e in self.ends[k:]]
        self.options = [[(t, e - cut) for t, e in o] for o in self.options[k:]]
        self.dead = {d - cut for d in self.dead if d > cut}
        self.held = self.held[cut:]
        return done


@cache
def symbol_bytes() -> dict[str, int]:
    """The byte that a symbol stands for."""
    return {s: b for b, s in enumerate(byte_symbols())}


class TextDecoder:
    """Ids to text, some at a time, with a state that does not grow.

    As bytes, a word end becomes a blank, and bytes that do not yet make a
    character wait. ``joined`` decodes as the library does where the file names
    no decoder: tokens as they stand in the vocabulary, a blank between each two;
    all that waits is whether a token came before.
    """

    def __init__(self, vocabulary: Vocabulary, joined: bool = False) -> None:
        self.vocabulary, self.joined = vocabulary, joined
        self.started = False
        self.byte_of = symbol_bytes()
        self.pending = codecs.getincrementaldecoder("utf-8")("replace")

    def push(self, ids: Iterable[int]) -> str:
        """The text that is certain after these ids."""
        if not self.joined:
            return "".join(map(self._as_bytes, ids))
        text = " ".join(map(self.vocabulary.tokens.__getitem__, ids))
        if text and self.started:
            text = " " + text
        self.started = self.started or bool(text)
        return text

    def _as_bytes(self, token_id: int) -> str:
        token = self.vocabulary.tokens[token_id]
        if token in self.vocabulary.special:
            return self.pending.decode(b"", True) + token
        word = token.removesuffix(WORD_END)
        text = self.pending.decode(bytes(self.byte_of[s] for s in word))
        return text + self.pending.decode(b"", True) + " " if len(word) < len(token) else text

    def finish(self) -> str:
        return self.pending.decode(b"", True)


class Remembered(dict):
    """Results of a function of a word; the words of late stay longest."""

    def __init__(self, compute) -> None:
        super().__init__()
        self.compute, self.older = compute, {}

    def __missing__(self, word: str) -> bytes:
        entry = self.older.get(word)
        if entry is None:
            entry = self.compute(word)
            if len(word) > REUSED_CHARS:
                return entry
        if len(self) >= REUSED_WORDS:
            self.older = dict(self)
            self.clear()
        self[word] = entry
        return entry


class Codec:
    """Texts to ids and decoded tokens; words between blanks are remembered as given."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary, self.transducer = vocabulary, Transducer(vocabulary)
        self.words = Remembered(self._normalized)
        self.parts = Remembered(self._encoded)
        found = "|".join(map(regex.escape, sorted(vocabulary.special, key=len, reverse=True)))
        self.special = regex.compile(f"({found})") if found else None

    def forget(self) -> None:
        """Give the remembered words back; the vocabulary stays."""
        for known in (self.words, self.parts):
            known.older = {}
            known.clear()
        self.transducer.pairs.clear()

    def _encoded(self, part: str) -> bytes:
        found = self.transducer.encode([part.encode("utf-8", "replace")])
        return b"".join([array("I", ids).tobytes() for ids in found])

    def _normalized(self, word: str) -> bytes:
        # Letter by letter, so that a sigma has one lower case wherever it stands.
        plain = unicodedata.normalize("NFC", word).replace("Σ", "σ").lower()
        parts = PIECES.findall(plain)
        return self.parts[parts[0]] if len(parts) == 1 else b"".join([self.parts[p] for p in parts])

    def pieces(self, text: str) -> Iterator[bytes]:
        """Ids of a text as bytes, some words at a time. No part reaches over a blank."""
        parts = self.special.split(text) if self.special and "<|" in text else [text]
        for part in parts:
            if part in self.vocabulary.special:
                yield np.array([self.vocabulary.special[part]], "<u4").tobytes()
                continue
            words = part.split() if part.isprintable() or not SEPARATORS.search(part) else BLANKS.split(part)
            for at in range(0, len(words), DIGEST_WORDS):
                yield b"".join([self.words[w] for w in words[at : at + DIGEST_WORDS]])

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of tokens, and SHA-256 of the ids and of the text that they decode to."""
        n, ids, decoded = 0, hashlib.sha256(), hashlib.sha256()
        decoder = TextDecoder(self.vocabulary, joined=True)
        for data in self.pieces(text):
            ids.update(data)
            decoded.update(decoder.push(np.frombuffer(data, "<u4").tolist()).encode())
            n += len(data) // 4
        decoded.update(decoder.finish().encode())
        return n, ids.hexdigest(), decoded.hexdigest()

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(b"".join(self.pieces(text)), "<u4").tolist()


def _shared(docs: DataFrame, path: str):
    with open(path, encoding="utf-8") as file:  # the driver's own installation
        return docs.sparkSession.sparkContext.broadcast(file.read())


_CODECS: dict[int, Codec] = {}


@contextmanager
def _codec(shared) -> Iterator[Codec]:
    """The codec of this worker process, which serves many tasks.

    Between tasks it keeps the vocabulary only: the worker may go on to work
    that needs the memory.
    """
    key = hash(shared.value)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(Vocabulary(shared.value))
    try:
        yield _CODECS[key]
    finally:
        _CODECS[key].forget()


def token_digests(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256``: one row per row of ``docs``.

    The whole text is encoded; a NULL text counts as empty and has no tokens.
    Repeated rows give equal rows; an empty table gives an empty result.
    """
    shared = _shared(docs, path)

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _codec(shared) as codec:
            for batch in batches:
                found = [codec.digest(t.as_py() or "") for t in batch.column(1)]
                n, ids, decoded = zip(*found) if found else ((),) * 3
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()),
                     pa.array(decoded, pa.string())],
                    names=["id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    schema = "id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(compute, schema).withColumnRenamed("id", id_col)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, ids``: the token ids of every text, none for a NULL text."""
    shared = _shared(docs, path)

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _codec(shared) as codec:
            for batch in batches:
                ids = [codec.encode(t.as_py() or "") for t in batch.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["id", "ids"]
                )

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(compute, "id bigint, ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col, text``: the lower-case text of ids, words a blank apart, trimmed."""
    shared = _shared(encoded, path)

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _codec(shared) as codec:
            for batch in batches:
                texts = []
                for ids in batch.column(1).to_pylist():
                    decoder = TextDecoder(codec.vocabulary)
                    texts.append((decoder.push(ids or []) + decoder.finish()).rstrip(" "))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(texts, pa.string())], names=["id", "text"]
                )

    rows = encoded.select(F.col(id_col).cast("bigint").alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(compute, "id bigint, text string").withColumnRenamed("id", id_col)
