"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

Text is cut into words where no piece of the vocabulary can reach across. The distinct
words of a step lie in one flat array of symbols. Each round finds every word's best pair
rank by a segmented minimum, merges its occurrences leftmost first, all words at once,
and compacts the array; words without a pair leave it. A piece that could itself take
part in a pair at least as good as its own is merged one occurrence a round, since the
sequential order would then go on with that pair.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from vecloom.llm.text import WordCache, col, helper, list_array, or_empty, spans_of, steps

MARK = "▁"
#: Words that a task remembers with their ids before it starts anew; a memory bound.
REMEMBERED = 300_000
#: Rounds before the few words that still merge are finished one by one.
ROUNDS = 64
NO_RANK = np.int64(1 << 40)


class PieceModel:
    """Vocabulary, merge ranks and byte pieces of a SentencePiece BPE model with byte fallback."""

    def __init__(self, path: str):
        self.library = library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = size = library.vocab_size()
        self.end = library.eos_id()
        normal = {}
        self.bytes = np.zeros(256, np.int32)
        self.surface: list[bytes] = []
        for i in range(size):
            piece = library.id_to_piece(i)
            if library.is_byte(i):
                value = int(piece[3:5], 16)
                self.bytes[value] = i
                self.surface.append(bytes([value]))
            elif library.is_control(i):
                self.surface.append(b"")
            elif library.is_unknown(i):
                self.surface.append(" ⁇ ".encode())
            else:
                normal[piece] = i
                self.surface.append(piece.replace(MARK, " ").encode())
        self.marked = np.zeros(size, bool)
        self.marked[[i for p, i in normal.items() if p[0] == MARK]] = True
        scores = {p: library.get_score(i) for p, i in normal.items()}
        places = {s: k for k, s in enumerate(sorted(set(scores.values()), reverse=True))}
        rank = {p: places[s] for p, s in scores.items()}
        self.chars = np.full(0x110000, -1, np.int32)
        keys, merged, ranks = [], [], []
        self.eager = np.zeros(size, bool)
        for piece, i in normal.items():
            if len(piece) == 1:
                self.chars[ord(piece)] = i
            for cut in range(1, len(piece)):
                left, right = piece[:cut], piece[cut:]
                if left in normal and right in normal:
                    keys.append(normal[left] * size + normal[right])
                    merged.append(i)
                    ranks.append(rank[piece])
                    for part in (left, right):
                        if len(part) > 1 and rank[piece] <= rank[part]:
                            self.eager[normal[part]] = True
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.array(keys, np.int64)[order]
        self.merged = np.array(merged, np.int64)[order]
        self.ranks = np.array(ranks, np.int64)[order]
        inner = any(MARK in p.lstrip(MARK) for p in normal)
        lines = any("\n" in p for p in normal)
        if inner:
            self.word = re.compile(r"(?s:.+)")
        else:
            self.word = re.compile(" *[^ ]+| +" if lines else " *[^ \n]+| +|\n+")
        self.words = WordCache(self.merge, REMEMBERED)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged piece of each pair of symbols."""
        key = np.where((left >= 0) & (right >= 0), left * self.size + right, -1)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK), self.merged[at]

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and where each word's begin; one more for the end."""
        points = np.frombuffer("".join(words).replace(" ", MARK).encode("utf-32-le"), np.uint32).astype(np.int64)
        lengths = np.array([len(w) for w in words], np.int64)
        symbols = np.where(self.chars[points] >= 0, self.chars[points], -1 - points).astype(np.int64)
        word = np.repeat(np.arange(len(words)), lengths)
        done_symbols, done_words = [], []
        rank, merged = np.full(len(symbols), NO_RANK), np.zeros(len(symbols), np.int64)
        inside = np.flatnonzero(word[1:] == word[:-1])
        rank[inside], merged[inside] = self._pairs(symbols[inside], symbols[inside + 1])
        for step in range(ROUNDS + 1):
            if not len(symbols):
                break
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            count = np.diff(np.r_[first, len(word)])
            best = np.repeat(np.minimum.reduceat(rank, first), count)
            over = best == NO_RANK
            done_symbols.append(symbols[over])
            done_words.append(word[over])
            live = ~over
            symbols, word, rank, merged, best = symbols[live], word[live], rank[live], merged[live], best[live]
            if not len(symbols):
                break
            if step == ROUNDS:
                self._one_by_one(symbols, word, done_symbols, done_words)
                break
            chosen = rank == best
            at = np.flatnonzero(chosen)
            run = np.r_[True, (at[1:] != at[:-1] + 1) | (word[at[1:]] != word[at[:-1]])]
            run_start = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            alone = self.eager[merged[at]]
            single = np.zeros(word[-1] + 1, bool)
            single[word[at[alone]]] = True
            leading = np.r_[True, word[at[1:]] != word[at[:-1]]]
            take = np.where(single[word[at]], leading, (np.arange(len(at)) - run_start) % 2 == 0)
            at = at[take]
            symbols[at] = merged[at]
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            symbols, word, rank, merged = symbols[stay], word[stay], rank[stay], merged[stay]
            at -= np.arange(len(at))
            changed = np.zeros(len(symbols), bool)
            changed[at] = changed[np.maximum(at - 1, 0)] = True
            fresh = np.flatnonzero(changed)
            rank[fresh] = NO_RANK
            fresh = fresh[fresh + 1 < len(word)]
            fresh = fresh[word[fresh] == word[fresh + 1]]
            rank[fresh], merged[fresh] = self._pairs(symbols[fresh], symbols[fresh + 1])
        symbols = np.concatenate(done_symbols) if done_symbols else np.zeros(0, np.int64)
        word = np.concatenate(done_words) if done_words else np.zeros(0, np.int64)
        order = np.argsort(word, kind="stable")
        return self._with_bytes(symbols[order], word[order], len(words))

    def _one_by_one(self, symbols: np.ndarray, word: np.ndarray, done_symbols: list, done_words: list) -> None:
        for w in np.unique(word):
            own = self._merged_word(symbols[word == w].tolist())
            done_symbols.append(np.array(own, np.int64))
            done_words.append(np.full(len(own), w))

    def _merged_word(self, symbols: list[int]) -> list[int]:
        """Merges of one word in order of rank and place, from a heap; for words of very many merges."""
        pairs = self._pair_table()
        after, before = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(symbols) and (found := pairs.get((symbols[i], symbols[j]))):
                heapq.heappush(heap, (found[0], i, symbols[i], symbols[j]))

        for i in range(len(symbols) - 1):
            offer(i)
        gone = [False] * len(symbols)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j >= len(symbols) or symbols[i] != left or symbols[j] != right:
                continue
            symbols[i] = pairs[left, right][1]
            gone[j] = True
            after[i] = after[j]
            if after[i] < len(symbols):
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [s for s, g in zip(symbols, gone) if not g]

    @lru_cache(maxsize=1)
    def _pair_table(self) -> dict[tuple[int, int], tuple[int, int]]:
        left, right = np.divmod(self.keys, self.size)
        return dict(zip(zip(left.tolist(), right.tolist()), zip(self.ranks.tolist(), self.merged.tolist())))

    def _with_bytes(self, symbols: np.ndarray, word: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
        """Symbols outside the vocabulary as the pieces of their UTF-8 bytes."""
        lengths, strange = np.ones(len(symbols), np.int64), symbols < 0
        encoded = {c: chr(-1 - c).encode() for c in np.unique(symbols[strange]).tolist()}
        for c, data in encoded.items():
            lengths[symbols == c] = len(data)
        ids = np.repeat(symbols, lengths)
        begin = np.cumsum(lengths) - lengths
        for c, data in encoded.items():
            for k, value in enumerate(data):
                ids[begin[symbols == c] + k] = self.bytes[value]
        per_word = np.bincount(word, weights=lengths, minlength=words).astype(np.int64)
        return ids.astype(np.int32), np.r_[0, np.cumsum(per_word)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row without end ids, and where each text's begin; one more for the end."""
        find = self.word.findall
        return self.words.look_up([find(" " + t.replace(MARK, " ")) if t else [] for t in texts])

    def decode(self, ids: np.ndarray) -> str:
        """Text of an id sequence."""
        ids = ids.tolist()
        pieces = [self.surface[i] for i in ids]
        first = next((k for k, data in enumerate(pieces) if data), None)
        if first is not None and self.marked[ids[first]]:
            pieces[first] = pieces[first][1:]
        try:
            if b"" not in pieces[:-1]:
                return b"".join(pieces).decode()
        except UnicodeDecodeError:
            pass
        return self.library.decode(ids)  # broken characters, or control ids inside the text


@lru_cache(maxsize=2)
def model(path: str) -> PieceModel:
    return PieceModel(path)


def encode(frame: DataFrame, path: str, text: str = "text", out: str = "ids", keys: list[str] | None = None) -> DataFrame:
    """The key columns (all but the text, if not named) and each whole text's ids with an end id.

    A column that is called like the output makes way for it. A null text is an empty one, which has the end id only. `path` must name the model file
    on every machine.
    """
    keys = [c for c in frame.columns if c not in (text, out)] if keys is None else keys
    body = helper("body")
    narrow = frame.select(*[col(k) for k in keys], or_empty(text).alias(body))
    schema = T.StructType([*[f for f in narrow.schema if f.name != body], T.StructField(out, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path)
        for batch in steps(batches, body):
            ids, starts = pieces.encode(batch.column(len(keys)).to_pylist())
            lengths = np.diff(starts)
            shifted = np.r_[0, np.cumsum(lengths + 1)]
            all_ids = np.full(shifted[-1], pieces.end, np.int32)
            all_ids[spans_of(shifted[:-1], lengths)] = ids
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], list_array(all_ids, shifted)], [*keys, out])

    return narrow.mapInArrow(run, schema)


def decode(frame: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """The frame with the text of each id sequence; null ids give the empty text.

    A column that is called like the output makes way for it.
    """
    frame = frame.drop(out)
    schema = T.StructType([*frame.schema.fields, T.StructField(out, T.StringType())])
    place = frame.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path)
        for whole in batches:
            for begin in range(0, whole.num_rows, 256):
                batch = whole.slice(begin, 256)
                column = batch.column(place)
                values, starts = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
                texts = [pieces.decode(values[a:b]) if ok else "" for a, b, ok in zip(starts[:-1], starts[1:], column.is_valid().to_pylist())]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, out])

    return frame.mapInArrow(run, schema)
