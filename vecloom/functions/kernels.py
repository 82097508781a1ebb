"""Numpy work on Arrow columns, run inside Spark tasks.

Everything here is a per-batch helper: Spark decides the partitions and moves the
rows. The module imports nothing from the package, so it can be pickled by value.
"""

from __future__ import annotations

import hashlib
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Fixed values of the keyed generator: a Mersenne prime, and the 24 bits a float32 keeps exactly.
PRIME = (1 << 31) - 1
FLOAT_BITS = 24

# Rows computed at a time, so that the intermediate integers stay in the processor's cache.
UNIFORM_ROWS = 256

# Every byte but a-z and 0-9 becomes a space.
WORD_BYTES = bytes(b if chr(b) in "abcdefghijklmnopqrstuvwxyz0123456789" else 32 for b in range(256))
SPACE = re.compile("[ \t\n\r]+")


# --- Arrow list columns <-> numpy matrices -------------------------------------------------


def to_matrix(column: pa.Array, dims: int) -> np.ndarray:
    """A list column whose rows all have `dims` values, as a float64 matrix (null value = NaN)."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.astype(np.float64).reshape(len(column), dims)


def to_vectors(matrix: np.ndarray, missing: np.ndarray | None = None) -> pa.Array:
    """Matrix rows as array<float>; rows flagged in `missing` become NULL."""
    rows, dims = matrix.shape
    offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * dims)
    values = pa.array(np.ascontiguousarray(matrix, dtype=np.float32).ravel())
    mask = None if missing is None or not missing.any() else pa.array(missing)
    return pa.ListArray.from_arrays(offsets, values, mask=mask)


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """L2-normalized rows; a zero row stays zero."""
    norms = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return matrix / np.where(norms == 0, 1.0, norms)


# --- keyed uniform vectors -----------------------------------------------------------------


def coefficient_table(dims: int) -> np.ndarray:
    """Three 31-bit constants per dimension, from md5 of their position."""
    return np.array(
        [
            [int(hashlib.md5(f"{part}-{i}".encode()).hexdigest()[:8], 16) >> 1 for i in range(dims)]
            for part in ("a", "b", "c")
        ],
        dtype=np.int64,
    )


def keyed_uniform(first: pa.Array, second: pa.Array, table: np.ndarray) -> pa.Array:
    """Uniform [0,1) vectors from two 31-bit seeds per row.

    (a*s1 + b*s2 + c) mod p, cut to 24 bits, so every value is an exact float below 1.
    """
    a, b, c = table
    one, two = first.to_numpy()[:, None], second.to_numpy()[:, None]
    out = np.empty((len(first), table.shape[1]), dtype=np.float32)
    for start in range(0, len(out), UNIFORM_ROWS):
        rows = slice(start, start + UNIFORM_ROWS)
        mixed = one[rows] * a
        mixed += two[rows] * b
        mixed += c
        mixed %= PRIME
        mixed >>= 31 - FLOAT_BITS
        out[rows] = mixed
    out /= np.float32(1 << FLOAT_BITS)
    return to_vectors(out)


# --- feature hashing -----------------------------------------------------------------------


def token_codes(words: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket (first four md5 bytes) and sign (top bit of the fifth) of each word."""
    digests = b"".join([hashlib.md5(w).digest() for w in words.cast(pa.binary()).to_pylist()])
    parts = np.frombuffer(digests, dtype=">u4").reshape(-1, 4)
    return (parts[:, 0] % dims).astype(np.int64), np.where(parts[:, 1] >> 31, -1.0, 1.0)


def split_words(lowered: pa.StringArray) -> pa.ListArray:
    """The runs of a-z and 0-9 in each text; every other byte, so every accented letter, is a break."""
    texts = pc.fill_null(lowered, "")
    _, offsets, data = texts.buffers()
    if not len(texts) or data is None:
        return pc.ascii_split_whitespace(texts)
    # A slice has the buffers of its whole batch; only its own bytes are copied.
    starts = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    spaced = data.slice(starts[0], starts[-1] - starts[0]).to_pybytes().translate(WORD_BYTES)
    plain = pa.StringArray.from_buffers(len(texts), pa.py_buffer(starts - starts[0]), pa.py_buffer(spaced))
    return pc.ascii_split_whitespace(pc.ascii_trim_whitespace(plain))


def hash_counts(lowered: pa.Array, dims: int) -> np.ndarray:
    """Signed word counts per bucket; each distinct word of the batch is hashed once."""
    words = split_words(lowered)
    lengths = pc.list_value_length(words).to_numpy(zero_copy_only=False)
    encoded = words.flatten().dictionary_encode()
    buckets, signs = token_codes(encoded.dictionary, dims)
    signs[pc.equal(encoded.dictionary, "").to_numpy(zero_copy_only=False)] = 0.0
    index = encoded.indices.to_numpy()
    cells = np.repeat(np.arange(len(lowered)) * dims, lengths) + buckets[index]
    counts = np.bincount(cells, weights=signs[index], minlength=len(lowered) * dims)
    return counts.reshape(len(lowered), dims)


def long_counts(lowered: bytes, dims: int) -> np.ndarray:
    """The counts of one text, from stretches of about TOKENIZE_BYTES that end where a word does."""
    counts, begin = np.zeros(dims), 0
    spaced = lowered.translate(WORD_BYTES)
    while begin < len(spaced):
        end = begin + TOKENIZE_BYTES
        if end < len(spaced):
            last = spaced.rfind(b" ", begin, end)
            end = last if last >= begin else spaced.find(b" ", end)
        end = len(spaced) if end < 0 else end
        counts += hash_counts(pa.array([spaced[begin:end].decode()], pa.string()), dims)[0]
        begin = end + 1
    return counts


# Bytes of text tokenized at a time, so that the token arrays stay small beside the batch, whatever its rows and texts.
TOKENIZE_BYTES = 1 << 20


def hash_vectors(batches: Iterator[pa.Array], dims: int) -> Iterator[pa.Array]:
    for lowered in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(lowered), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        counts = np.zeros((len(lowered), dims))
        begin = 0
        while begin < len(lowered):
            most = (ends[begin - 1] if begin else 0) + TOKENIZE_BYTES
            end = int(np.searchsorted(ends, most, side="right"))
            if end > begin:
                counts[begin:end] = hash_counts(lowered.slice(begin, end - begin), dims)
            else:
                end = begin + 1
                counts[begin] = long_counts(lowered[begin].as_buffer().to_pybytes(), dims)
            begin = end
        missing = lowered.is_null().to_numpy(zero_copy_only=False)
        yield to_vectors(unit_rows(counts), missing)


# --- calling a model -----------------------------------------------------------------------

Encoder = Callable[[list[str]], "list[list[float] | None] | np.ndarray"]


class ModelOutage(RuntimeError):
    """A model answers nothing, whatever the text."""


@dataclass(frozen=True)
class Retry:
    """How often a model that does not answer is asked, the seconds between, and a text any model takes."""

    attempts: int
    wait: float
    probe: str


def _asked(encode: Encoder, texts: list[str]) -> tuple[list, list[str | None]]:
    """One call; if it fails, one call per text, with the reason for each that fails alone."""
    try:
        found = list(encode(texts))
        if len(found) == len(texts):
            return found, [None if v is not None else "the model gives no vector" for v in found]
        reason = f"{len(found)} vectors for {len(texts)} texts"
    except Exception as error:
        reason = f"{type(error).__name__}: {error}"
    if len(texts) == 1:
        return [None], [reason]
    each = [_asked(encode, [t]) for t in texts]
    return [v[0] for v, _ in each], [r[0] for _, r in each]


def encode_slice(encode: Encoder, texts: list[str], retry: Retry) -> tuple[list, list[str | None]]:
    """Vectors and reasons of a slice; raises if the model is down.

    Where every text fails, a probe tells bad texts from a model that is down.
    """
    for attempt in range(retry.attempts):
        found, reasons = _asked(encode, texts)
        if any(v is not None for v in found):
            return found, reasons
        if _asked(encode, [retry.probe])[0][0] is not None:
            return found, reasons
        if attempt + 1 < retry.attempts:
            time.sleep(retry.wait)
    raise ModelOutage(f"no answer in {retry.attempts} attempts: {reasons[0]}")


def byte_units(text: str) -> int:
    return len(text.encode())


def _halves(part: str, count: Callable[[str], int], most: int) -> list[tuple[str, int]]:
    """A part without spaces in pieces of at most `most` units; a single character is not split."""
    units = count(part)
    if units <= most or len(part) < 2:
        return [(part, units)]
    middle = len(part) // 2
    return _halves(part[:middle], count, most) + _halves(part[middle:], count, most)


def split_windows(text: str, most: int, count: Callable[[str], int] | None = None) -> list[tuple[str, int]]:
    """A text as consecutive windows of at most `most` units, with their units.

    Windows end at spaces where they can; what has no space is split inside.
    """
    count = count or byte_units
    space = count(" ")
    whole = count(text)
    if whole <= most:
        return [(text, max(whole, 1))]
    windows: list[tuple[str, int]] = []
    held: list[str] = []
    units = 0
    for word in SPACE.split(text):
        for part, size in _halves(word, count, most) if word else []:
            if held and units + space + size > most:
                windows.append((" ".join(held), units))
                held, units = [], 0
            held.append(part)
            units += size + (space if units else 0)
    return [*windows, (" ".join(held), max(units, 1))] if held else windows or [("", 1)]


def encode_column(
    encode: Encoder, column: pa.Array, slice_rows: int, normalize: bool, windows: tuple, retry: Retry
) -> pa.Array:
    """One (vector, reason) per text; null in gives null out.

    A long text is encoded window by window and the windows are averaged by their units,
    so the whole text counts. Each slice is added up as one matrix.
    """
    most, count = windows
    owners: list[int] = []
    weights: list[int] = []
    texts: list[str] = []
    for row, text in enumerate(column.to_pylist()):
        for part, units in [] if text is None else split_windows(text, most, count) if most else [(text, 1)]:
            owners.append(row)
            weights.append(units)
            texts.append(part)

    rows = len(column)
    reasons: list[str | None] = [None] * rows
    sums: np.ndarray | None = None
    lengths = np.full(rows, -1)
    # Vectors of a length of their own: kept as they are, for the length check that follows.
    odd: dict[int, np.ndarray] = {}
    for start in range(0, len(texts), slice_rows):
        found, why = encode_slice(encode, texts[start : start + slice_rows], retry)
        good = [k for k, v in enumerate(found) if v is not None]
        for k, reason in enumerate(why):
            if found[k] is None:
                reasons[owners[start + k]] = reasons[owners[start + k]] or reason
        vectors = [np.asarray(found[k], dtype=np.float64) for k in good]
        owner = np.array([owners[start + k] for k in good], dtype=np.int64)
        weight = np.array([weights[start + k] for k in good], dtype=np.float64)
        if sums is None and vectors:
            sums = np.zeros((rows, len(vectors[0])))
        fits = [k for k, v in enumerate(vectors) if v.shape == sums.shape[1:]]
        for k in set(range(len(vectors))) - set(fits):
            odd[int(owner[k])] = vectors[k]
        if fits:
            np.add.at(sums, owner[fits], np.stack([vectors[k] for k in fits]) * weight[fits, None])
            lengths[owner[fits]] = sums.shape[1]

    good = (lengths >= 0) & np.array([r is None for r in reasons], dtype=bool)
    total = np.bincount(np.array(owners, np.int64), np.array(weights, float), rows) if owners else np.zeros(rows)
    if sums is None:
        sums = np.zeros((rows, 0))
    result = unit_rows(sums) if normalize else sums / np.maximum(total, 1)[:, None]
    if odd:
        listed = [odd.get(k, result[k] if good[k] else None) for k in range(rows)]
        listed = [None if reasons[k] is not None else v for k, v in enumerate(listed)]
        vectors = pa.array([None if v is None else v.astype(np.float32) for v in listed], pa.list_(pa.float32()))
    else:
        vectors = to_vectors(result, ~good)
    return pa.StructArray.from_arrays([vectors, pa.array(reasons, pa.string())], ["vector", "reason"])


def encode_batches(
    batches: Iterator[pa.Array],
    factory: Callable[[], Encoder],
    slice_rows: int,
    normalize: bool,
    windows: tuple,
    retry: Retry,
) -> Iterator[pa.Array]:
    encode = factory()
    for column in batches:
        yield encode_column(encode, column, slice_rows, normalize, windows, retry)


# --- similarity search ---------------------------------------------------------------------

# Scores held at a time, so that the score matrix stays in the processor's cache, and the
# queries among them.
SCORE_CELLS, SCORE_QUERIES = 1 << 20, 1024


def directions(matrix: np.ndarray) -> np.ndarray:
    """Unit rows; a zero row, which has no direction, becomes NaN."""
    norms = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return matrix / np.where(norms == 0, np.nan, norms)


def in_order(values: np.ndarray) -> np.ndarray:
    """Sums of rows, value after value, as the column expressions add them up; numpy's own sum adds in blocks."""
    return np.cumsum(values, axis=1)[:, -1] if values.shape[1] else np.zeros(len(values))


def pair_gains(queries: np.ndarray, records: np.ndarray, metric: str) -> np.ndarray:
    """Gain of each query with the record beside it, higher is better.

    Each pair is summed for itself, so that equal vectors have equal gains wherever they lie.
    """
    if metric == "euclidean":
        return -np.sqrt(in_order((records - queries) ** 2))
    products = in_order(queries * records)
    if metric == "dot_product":
        return products
    squares, others = in_order(queries * queries), in_order(records * records)
    with np.errstate(over="ignore"):
        both = squares * others
    norms = np.where((both > 0) & (both < np.inf), np.sqrt(both), np.sqrt(squares) * np.sqrt(others))
    return np.clip(products / np.where(norms == 0, np.nan, norms), -1.0, 1.0)


def rough_gains(queries: np.ndarray, records: np.ndarray, metric: str) -> tuple[np.ndarray, float]:
    """queries x records by one matrix product, and how far off its values may be.

    Euclidean gains are squared distances with the sign turned. Undefined ones are NaN.
    """
    products = queries @ records.T
    if metric != "euclidean":
        largest = np.nanmax(np.abs(products), initial=0.0)
        return products, 1e-12 * max(1.0, largest) * queries.shape[1]
    squares, others = (queries * queries).sum(axis=1), (records * records).sum(axis=1)
    products *= 2
    products -= squares[:, None]
    products -= others[None, :]
    return products, 1e-13 * (np.nanmax(squares, initial=0.0) + np.nanmax(others, initial=0.0)) * queries.shape[1]


def keep_best(pool: pa.Table, k: int, key: str) -> pa.Table:
    """The k best candidates of each query: best score first, smaller key first on ties."""
    order = pc.sort_indices(
        pool, sort_keys=[("_query", "ascending"), ("_gain", "descending"), (key, "ascending")]
    )
    query = pool["_query"].to_numpy()[order.to_numpy()]
    rank = np.arange(len(query)) - np.searchsorted(query, query, side="left")
    return pool.take(order.filter(pa.array(rank < k)))


class BestPool:
    """The k best records of each query so far, with a buffer that is pruned when it has doubled."""

    def __init__(self, queries: np.ndarray, k: int, key: str, columns: list[str], metric: str):
        self.queries, self.k, self.key, self.columns, self.metric = queries, k, key, columns, metric
        self.rough = directions(queries) if metric == "cosine" else queries
        self.floor = np.full(len(queries), -np.inf)
        self.parts: list[pa.Table] = []
        self.rows, self.kept = 0, 0

    def offer(self, batch: pa.RecordBatch, records: np.ndarray, asking: np.ndarray, left_out: np.ndarray | None = None) -> None:
        """Records that can still be among the best of the asking queries go into the buffer, but for pairs left out."""
        sides = directions(records) if self.metric == "cosine" else records
        gains, slack = rough_gains(self.rough[asking], sides, self.metric)
        if left_out is not None:
            gains = np.where(left_out, np.nan, gains)
        floor = self.floor[asking]
        # A gain is compared with the floor on its own scale.
        bar = -(floor * floor) if self.metric == "euclidean" else floor
        able = gains >= (bar - slack)[:, None]
        if gains.shape[1] > self.k and np.count_nonzero(able) > 4 * self.k * len(asking):
            known = np.where(np.isnan(gains), -np.inf, gains)
            best = np.partition(known, gains.shape[1] - self.k, axis=1)[:, gains.shape[1] - self.k]
            able = gains >= (np.maximum(bar, best) - slack)[:, None]
        query, row = np.divmod(np.flatnonzero(able), gains.shape[1])
        if not len(query):
            return
        gain = pair_gains(self.queries[asking[query]], records[row], self.metric)
        able = ~np.isnan(gain) & (gain >= floor[query])
        query, row, gain = query[able], row[able], gain[able]
        if len(query) > 2 * self.k * len(asking):
            # Many ties, as among copies: the k best by gain and key are enough.
            rank = np.empty(batch.num_rows, np.int64)
            rank[pc.sort_indices(batch.column(self.key)).to_numpy()] = np.arange(batch.num_rows)
            order = np.lexsort((rank[row], -gain, query))
            place = np.arange(len(order)) - np.searchsorted(query[order], query[order], side="left")
            order = order[place < self.k]
            query, row, gain = query[order], row[order], gain[order]
        picked = {"_query": pa.array(asking[query]), "_gain": pa.array(gain)}
        for name in self.columns:
            picked[name] = batch.column(name).take(pa.array(row))
        self.parts.append(pa.table(picked))
        self.rows += len(query)
        if self.rows > 2 * max(self.kept, 4096):
            self.prune()

    def prune(self) -> pa.Table | None:
        if not self.parts:
            return None
        pool = keep_best(pa.concat_tables(self.parts), self.k, self.key)
        self.parts, self.rows, self.kept = [pool], pool.num_rows, pool.num_rows
        held = pool["_query"].to_numpy()
        count = np.bincount(held, minlength=len(self.floor))
        end = np.cumsum(count) - 1
        full = count >= self.k
        self.floor[full] = pool["_gain"].to_numpy()[end[full]]
        return pool


def best_per_query(
    batches: Iterator[pa.RecordBatch],
    queries: np.ndarray,
    k: int,
    key: str,
    vector: str,
    columns: list[str],
    metric: str,
    probes: np.ndarray | None = None,
    cells: str | None = None,
    table: str | None = None,
) -> pa.Table | None:
    """Scan record batches, holding a small multiple of k candidates per query at any time.

    With `probes` (tables x queries x cells, true where a query looks) the batches are index
    rows: a record once for each table, with its cells in all of them. A query meets a
    record in the first table in which it looks into the record's cell.
    """
    pool = BestPool(queries, k, key, columns, metric)

    def offer_in_steps(batch: pa.RecordBatch, asking: np.ndarray, placed: np.ndarray | None = None) -> None:
        if not batch.num_rows or not len(asking):
            return
        step = max(1, SCORE_CELLS // min(len(asking), SCORE_QUERIES))
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            records = to_matrix(part.column(vector), queries.shape[1])
            for first in range(0, len(asking), SCORE_QUERIES):
                some, met = asking[first : first + SCORE_QUERIES], None
                for earlier in range(0 if placed is None else placed.shape[1] - 1):
                    here = probes[earlier][np.ix_(some, placed[start : start + step, earlier])]
                    met = here if met is None else met | here
                pool.offer(part, records, some, met)

    for batch in batches:
        if probes is None:
            offer_in_steps(batch, np.arange(len(queries)))
            continue
        if not batch.num_rows:
            continue
        placed = batch.column(cells).flatten().to_numpy().reshape(batch.num_rows, -1)
        tables = batch.column(table).to_numpy()
        for t in np.unique(tables):
            own = np.where(tables == t, placed[:, t], -1)
            # Rows come sorted by cell.
            for cell in np.unique(own[own >= 0]):
                inside = own == cell
                some = batch if inside.all() else batch.filter(pa.array(inside))
                offer_in_steps(some, np.flatnonzero(probes[t][:, cell]), placed[inside][:, : t + 1])

    best = pool.prune()
    if best is None:
        return None
    sign = -1.0 if metric == "euclidean" else 1.0
    return best.append_column("score", pa.array(sign * best["_gain"].to_numpy() + 0.0))


def hyperplanes(bits: int, dims: int, table: int) -> np.ndarray:
    """+1/-1 hyperplanes of a hash table, from md5 of the table and their position."""
    return np.array(
        [
            [1 if hashlib.md5(f"{table}-{j}-{i}".encode()).hexdigest()[0] < "8" else -1 for i in range(dims)]
            for j in range(bits)
        ],
        dtype=np.float64,
    )


def sign_cells(margins: np.ndarray) -> np.ndarray:
    """One bit per hyperplane: on which side the vector lies."""
    return (margins > 0).astype(np.int64) @ (1 << np.arange(margins.shape[1], dtype=np.int64))


def cells_looked_into(margins: np.ndarray, cosines: np.ndarray, first: int, share: float) -> np.ndarray:
    """For each query (its distances to the planes of a table) the cells that it looks into, likeliest first, as truth values.

    A vector at angle a from the query lies on the other side of a plane at distance m with
    chance F(-m / tan a), F being the normal distribution, for which a logistic curve stands here.
    Cells are taken by the sum of the distances to the planes crossed until the chance that such a
    vector lies in one of them is `share`, and `first` cells at least.
    """
    rows, bits = margins.shape
    cosine = np.clip(cosines, 0.0, 0.999999)
    slope = 1.702 * cosine / np.sqrt(1 - cosine * cosine)
    crossed = 1 / (1 + np.exp(np.minimum(np.abs(margins) * slope[:, None], 700)))
    chance, cost = np.ones((rows, 1)), np.zeros((rows, 1))
    for j in range(bits):
        chance = np.concatenate([chance * (1 - crossed[:, j : j + 1]), chance * crossed[:, j : j + 1]], axis=1)
        cost = np.concatenate([cost, cost + np.abs(margins[:, j : j + 1])], axis=1)
    order = np.argsort(cost, axis=1, kind="stable")
    sums = np.cumsum(np.take_along_axis(chance, order, 1), axis=1)
    taken = np.concatenate([np.ones((rows, 1), bool), sums[:, :-1] < share], axis=1)
    taken[:, :first] = True
    out = np.zeros((rows, 1 << bits), bool)
    np.put_along_axis(out, order ^ sign_cells(margins)[:, None], taken, 1)
    return out
