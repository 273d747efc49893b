"""Near-duplicate documents by Order MinHash, verified by banded alignment.

Three-word k-mers are labelled with their occurrence, so that repetitions count: even if every fifth
word differs, two fifths of them are left. In short texts, where few would be, single words are
sketched as well. Each of several
sketches takes the few k-mers of smallest hash and keeps them in the order of the text: two texts
agree in a sketch only if they share these k-mers in the same order, so the chance to agree falls
with the edit distance, moved passages included. Texts that agree in a sketch share a bucket.

Buckets propose links, alignment decides: texts are near duplicates if at most a fifth as many word
edits as the longer has words turn one into the other. Exact copies are one text. In each bucket all
texts are first compared with a leader. Where a bucket still holds texts that are not connected, they
meet pair by pair in blocks of bounded size, as signatures of 128 bytes: clipped word counts, whose
overlap bounds the edit distance from below. The plausible pairs, each once, then meet with their
words and are aligned. A block with very many plausible pairs gets the words of its texts instead and
aligns, the most similar first, what it has not connected yet, each pair in the bucket of the first
sketch that it agrees in; it returns a forest of links, not its pairs. Every proposed link between
texts not yet connected is decided, and no bucket is capped.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from lexiform.cluster import fresh_path
from lexiform.llm.batches import chunks_of_text, record_batch
from lexiform.llm.components import components

K = 3  # words of a k-mer
SKETCHES = 80
SHORT = 50  # words of texts that also have sketches of single words
SHORT_SKETCHES = 24
KEPT = 2  # k-mers of a sketch
SIMILARITY = 0.8
BAG = 256  # buckets of the word counts that bound the edit distance
LEVELS = 4  # word counts of a signature are clipped here
SIGNATURE = BAG * LEVELS // 8  # bytes of a signature
BLOCK = 2048  # texts of a block of what is left in a bucket
STEP = 256  # texts of a block that meet the others at a time
FIRST_STEP = 8  # texts of a dense block that meet the others first
DENSE = 16  # plausible pairs for each text of a block, beyond which the words come to the block
BITS = 4096  # words up to which texts are aligned with a bit for each word of one of them
DIAGONALS = 64  # edits up to which single diagonals are followed
MARKS = 16  # bits for each wanted id, of which about a sixteenth of the other ids finds one set
MOST_MARKS = 1 << 27  # bits at most: 16 MB
BITMAP = 4096  # bytes of a bucket of Spark's bitmaps
RESUME = 12  # words ahead in which a simple alignment looks for its next run


def words_of(text: str) -> list[str]:
    return text.lower().split()


def word_hashes(words: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, the same on every machine, and the number of words of each text."""
    flat = np.array([w for ws in words for w in ws], dtype=object)
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    if not len(flat):
        return np.zeros(0, np.uint64), lengths
    return pd.util.hash_array(flat, categorize=True), lengths


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def bucket_keys(hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All keys of each text, those of single words last; 0 where a text has none."""
    out = np.zeros((len(lengths), SKETCHES + SHORT_SKETCHES), np.int64)
    out[:, :SKETCHES] = sketches(hashes, lengths)
    short = lengths <= SHORT
    words = hashes[np.repeat(short, lengths)]
    out[short, SKETCHES:] = sketches(words, lengths[short], 1, SHORT_SKETCHES)
    return out


def sketches(
    hashes: np.ndarray, lengths: np.ndarray, k: int = K, count: int = SKETCHES
) -> np.ndarray:
    """``count`` bucket keys per text; those without words get 0 and are to be left out."""
    n_texts = len(lengths)
    out = np.zeros((n_texts, count), np.int64)
    sizes = np.where(lengths >= k, lengths - k + 1, (lengths > 0).astype(np.int64))
    some = np.flatnonzero(sizes)
    if not len(some):
        return out
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    firsts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    owner = np.repeat(np.arange(n_texts), sizes)
    at = np.arange(len(owner)) - firsts[owner] + starts[owner]
    padded = np.concatenate([hashes, np.zeros(k, np.uint64)])
    kmers = np.zeros(len(owner), np.uint64)
    for i in range(k):
        inside = np.uint64(1) * (i < lengths[owner])
        kmers = mixed(kmers * np.uint64(31) + padded[at + i] * inside + np.uint64(i + 1))
    # The n-th occurrence of a k-mer in a text is a k-mer of its own.
    keyed = pd.Series(kmers ^ mixed(owner.astype(np.uint64) + np.uint64(1)))
    again = np.flatnonzero(keyed.duplicated(keep=False).to_numpy())
    if len(again):
        occurrence = keyed.iloc[again].groupby(keyed.iloc[again]).cumcount().to_numpy()
        kmers[again] = mixed(kmers[again] + occurrence.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    segments = firsts[some]
    texts = np.repeat(np.arange(len(some)), sizes[some])
    far = np.uint64(0xFFFFFFFFFFFFFFFF)
    rng = np.random.default_rng(20)
    for r in range(count):
        odd, shift = rng.integers(1, 1 << 63, 2, dtype=np.uint64)
        ranks = (kmers ^ shift) * (odd | np.uint64(1))
        ranks ^= ranks >> np.uint64(32)
        places = []
        for _ in range(KEPT):
            least = np.minimum.reduceat(ranks, segments)
            hits = np.flatnonzero(ranks == least[texts])
            place = np.full(len(some), -1, np.int64)
            place[texts[hits][::-1]] = hits[::-1]  # the first of equals
            places.append(place)
            ranks[place] = far
        key = np.full(len(some), mixed(np.array([r + 1 + (K - k) * SKETCHES], np.uint64))[0])
        for place in np.sort(np.stack(places), axis=0):
            key = mixed(key * np.uint64(31) + kmers[place])
        out[some, r] = key.view(np.int64)
    return out


def within(a: np.ndarray, b: np.ndarray, allowed: int) -> bool:
    """Whether at most ``allowed`` word edits turn a into b."""
    if abs(len(a) - len(b)) > allowed:
        return False
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    if len(a) == len(b) and len(differ) <= allowed:
        return True
    start = int(differ[0]) if len(differ) else n
    a, b = a[start:], b[start:]
    n = min(len(a), len(b))
    if n:
        differ = np.flatnonzero(a[::-1][:n] != b[::-1][:n])
        end = int(differ[0]) if len(differ) else n
        a, b = a[: len(a) - end], b[: len(b) - end]
    if not len(a) or not len(b):
        return max(len(a), len(b)) <= allowed
    if max(len(a), len(b)) <= BITS:
        return _by_bits(a, b, allowed)
    if _greedy(a, b, allowed):
        return True
    found = _by_diagonals(a, b, min(allowed, DIAGONALS))
    if found or allowed <= DIAGONALS:
        return found
    return _by_band(a, b, allowed)


def _by_bits(a: np.ndarray, b: np.ndarray, allowed: int) -> bool:
    """Myers' bit-parallel edit distance: a column of differences is two integers, one bit a row.

    ``distance`` is that of all of a and what was read of b; each word still to come lowers it by
    one at most."""
    places: dict[int, int] = {}
    for i, word in enumerate(a.tolist()):
        places[word] = places.get(word, 0) | 1 << i
    n, left = len(a), len(b)
    every, last = (1 << n) - 1, 1 << n - 1
    up, down, distance = every, 0, n
    for word in b.tolist():
        equal = places.get(word, 0)
        level = equal | down
        across = (((equal & up) + up) ^ up) | equal
        more, less = down | ~(across | up) & every, up & across
        if more & last:
            distance += 1
        elif less & last:
            distance -= 1
        left -= 1
        if distance - left > allowed:
            return False
        more, less = (more << 1 | 1) & every, less << 1 & every
        up, down = less | ~(level | more) & every, more & level
    return distance <= allowed


def _greedy(a: np.ndarray, b: np.ndarray, allowed: int) -> bool:
    """Whether one simple alignment needs few enough edits: equal runs, joined by the nearest place
    where three words agree again. Finds most near texts; says nothing of others."""
    i = j = edits = 0
    while i < len(a) and j < len(b) and edits <= allowed:
        step = min(len(a) - i, len(b) - j, 512)
        differ = a[i : i + step] != b[j : j + step]
        run = int(differ.argmax())
        if not differ[run]:
            i, j = i + step, j + step
            continue
        i, j = i + run, j + run
        same = a[i : i + RESUME, None] == b[None, j : j + RESUME]
        x, y = np.nonzero(same[:-2, :-2] & same[1:-1, 1:-1] & same[2:, 2:])
        if not len(x):
            break
        best = int(np.argmin(np.maximum(x, y) * RESUME + x + y))
        i, j = i + int(x[best]), j + int(y[best])
        edits += max(int(x[best]), int(y[best]))
    return edits + max(len(a) - i, len(b) - j) <= allowed


def _by_diagonals(a: np.ndarray, b: np.ndarray, allowed: int) -> bool:
    """How far each diagonal of the band is reached with 0, 1, ... edits."""
    n, m = len(a), len(b)
    mismatches: dict[int, list[int]] = {}

    def slide(k: int, i: int) -> int:
        """From row i along diagonal k (column - row) to the next mismatch or an end."""
        if k not in mismatches:
            low, high = max(0, -k), min(n, m - k)
            found = np.flatnonzero(a[low:high] != b[low + k : high + k]) + low
            mismatches[k] = [*found.tolist(), high]
        stops = mismatches[k]
        return stops[min(bisect_left(stops, i), len(stops) - 1)] if i < stops[-1] else i

    goal = m - n
    reached = {0: slide(0, 0)}
    for edits in range(allowed + 1):
        if reached.get(goal, -1) >= n:
            return True
        if edits == allowed:
            return False
        following = {}
        for k in range(-edits - 1, edits + 2):
            i = max(
                reached.get(k, -2) + 1, reached.get(k - 1, -2), reached.get(k + 1, -2) + 1
            )
            if i < max(0, -k) or k > m or -k > n:
                continue
            i = min(i, n, m - k)
            following[k] = slide(k, i)
        reached = following
    return False


def _by_band(a: np.ndarray, b: np.ndarray, allowed: int) -> bool:
    """Row-wise edit distance inside a band around the diagonal, all of the band at once."""
    n, m = len(a), len(b)
    width = 2 * allowed + 1
    offsets = np.arange(width) - allowed
    far = np.int32(1 << 29)
    row = np.where((offsets >= 0) & (offsets <= m), offsets, far).astype(np.int32)
    steps = np.arange(width, dtype=np.int32)
    for i in range(1, n + 1):
        columns = offsets + i
        valid = (columns >= 1) & (columns <= m)
        equal = np.zeros(width, bool)
        equal[valid] = b[columns[valid] - 1] == a[i - 1]
        replaced = row + (~equal)
        deleted = np.append(row[1:], far) + 1
        best = np.where(valid, np.minimum(replaced, deleted), np.where(columns == 0, i, far))
        row = (np.minimum.accumulate(best - steps) + steps).astype(np.int32)
        row[(columns < 0) | (columns > m)] = far
        if row.min() > allowed:
            return False
    return bool(row[m - n + allowed] <= allowed)


def near(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    longer = max(len(a), len(b))
    return within(a, b, int(longer * (1 - similarity) + 1e-9))


def bags(hashes: np.ndarray) -> np.ndarray:
    return np.bincount((hashes % BAG).astype(np.int64), minlength=BAG).astype("<u4")


def signature(hashes: np.ndarray) -> bytes:
    """Word counts up to LEVELS, as so many bits each. Common bits are words that may be shared."""
    return np.packbits(bags(hashes)[:, None] > np.arange(LEVELS, dtype=np.uint32)).tobytes()


def signature_rows(column: pa.Array) -> np.ndarray:
    """A column of signatures as rows of bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, SIGNATURE)


def edits_allowed(n_words: np.ndarray, similarity: float) -> np.ndarray:
    return np.floor(n_words * (1 - similarity) + 1e-9).astype(np.int64)


def words_apart(a: np.ndarray, b: np.ndarray) -> int:
    """The least number of edits that the words of two texts need in any order."""
    _, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    gaps = np.bincount(place[: len(a)], minlength=place.max(initial=0) + 1)
    gaps = gaps - np.bincount(place[len(a) :], minlength=len(gaps))
    return int(max(gaps[gaps > 0].sum(), -gaps[gaps < 0].sum()))


def proposed(
    signatures: np.ndarray, n: np.ndarray, part: np.ndarray, left: np.ndarray, right: np.ndarray | None,
    similarity: float = SIMILARITY, dense: int = DENSE,
):
    """Pairs (i, j) of ``left`` and ``right`` (None: of ``left`` itself, each once) that may be near;
    near pairs of different components always are. None if there are more than ``dense`` a text."""
    same, right = right is None, left if right is None else right
    most = dense * (len(left) + (0 if same else len(right)))
    bits = np.unpackbits(signatures[right], axis=1).astype(np.float32)
    ones, allowed = bits.sum(1), edits_allowed(n[right], similarity)
    found_i, found_j, total = [], [], 0
    for at in range(0, len(left), STEP):
        rows = left[at : at + STEP]
        if same:
            own, own_ones, own_allowed = (x[at : at + STEP] for x in (bits, ones, allowed))
        else:
            own = np.unpackbits(signatures[rows], axis=1).astype(np.float32)
            own_ones, own_allowed = own.sum(1), edits_allowed(n[rows], similarity)
        limit = np.maximum(own_allowed[:, None], allowed)
        fine = np.maximum(own_ones[:, None], ones) - own @ bits.T <= limit
        fine &= part[rows][:, None] != part[right]
        fine &= np.abs(n[rows][:, None] - n[right]) <= limit
        if same:
            fine &= np.arange(at, at + len(rows))[:, None] < np.arange(len(right))
        i, j = np.nonzero(fine)
        total += len(i)
        if total > most:
            return None
        found_i.append(rows[i])
        found_j.append(right[j])
    return np.concatenate(found_i), np.concatenate(found_j)


def plausible(a: dict, b: dict, key: int | None, similarity: float = SIMILARITY):
    """Pairs (i, j) of two blocks that may be near, and their bag distances; near pairs always pass.

    Left out are pairs of one component, pairs that a bucket of an earlier sketch decides, and pairs
    whose word counts need too many edits. ``key`` is the block's bucket; None takes every pair.
    """
    n_a, n_b = a["n"][:, None], b["n"][None, :]
    allowed = np.floor(np.maximum(n_a, n_b) * (1 - similarity) + 1e-9)
    i, j = np.nonzero((a["part"][:, None] != b["part"][None, :]) & (np.abs(n_a - n_b) <= allowed))
    found_i, found_j, distances = [], [], []
    for at in range(0, len(i), 4096):
        x, y = i[at : at + 4096], j[at : at + 4096]
        if key is not None:
            agree = a["keys"][x] == b["keys"][y]
            first = a["keys"][x, agree.argmax(1)] == key
            x, y = x[first], y[first]
        gaps = a["bags"][x] - b["bags"][y]
        size = np.abs(gaps).sum(1)
        needed = (size + np.abs(gaps.sum(1))) // 2  # the larger of what is missing and what is extra
        fine = needed <= allowed[x, y]
        found_i.append(x[fine])
        found_j.append(y[fine])
        distances.append(size[fine])
    if not found_i:
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, nothing
    return np.concatenate(found_i), np.concatenate(found_j), np.concatenate(distances)


def _digest(words: list[str]) -> str:
    return hashlib.md5("\x1f".join(words).encode("utf-8", "surrogatepass")).hexdigest()


def _sketched(rows: DataFrame) -> DataFrame:
    """(doc_id, digest, n_words, keys) of every document."""
    schema = StructType(
        [
            rows.schema["doc_id"],
            StructField("digest", StringType()),
            StructField("n_words", LongType()),
            StructField("keys", ArrayType(LongType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks_of_text(batches):
            words = [words_of(t) for t in texts]
            keys = bucket_keys(*word_hashes(words))
            offsets = np.arange(0, keys.size + 1, keys.shape[1], dtype=np.int32)
            yield record_batch(
                schema,
                {
                    "doc_id": part.column("doc_id"),
                    "digest": [_digest(w) for w in words],
                    "n_words": [len(w) for w in words],
                    "keys": pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel())),
                },
            )

    return rows.mapInArrow(run, schema)


def marked(ids: DataFrame, column: str) -> tuple[int, bytes]:
    """How many marks there are, and as bits those of an id's xxhash64 modulo that number.

    An id whose bit is not set is not among ``ids``. There are MARKS bits for each id, but at most
    MOST_MARKS: of more ids than these allow, more others find their bit set as well.
    """
    many = min(MOST_MARKS, MARKS * max(1, ids.count()))
    place = (F.pmod(F.xxhash64(column), F.lit(many)) + 1).alias("place")  # bitmaps begin at 1
    found = (
        ids.select(place)
        .groupBy(F.bitmap_bucket_number("place").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
        .toArrow()
    )
    held = dict(zip(found["bucket"].to_pylist(), found["bits"].to_pylist()))
    buckets = range(1, many // (8 * BITMAP) + 2)
    return many, b"".join(held.get(bucket, bytes(BITMAP)) for bucket in buckets)


def has_mark(bits: bytes, at: np.ndarray) -> np.ndarray:
    """Whether the bits with these numbers are set."""
    return np.frombuffer(bits, np.uint8)[at >> 3] >> (at & 7) & 1 == 1


def _texts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, n, signature, words) of the wanted texts (node, rep, digest); words as 32-bit hashes."""
    digested = StructType(
        [
            rows.schema["doc_id"],
            StructField("digest", StringType()),
            StructField("n", LongType()),
            StructField("signature", BinaryType()),
            StructField("words", BinaryType()),
        ]
    )

    many, bits = marked(wanted, "rep")
    marks = rows.sparkSession.sparkContext.broadcast(bits)

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("at").to_numpy()
            yield batch.filter(pa.array(has_mark(marks.value, at)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks_of_text(likely(batches)):
            words = [words_of(t) for t in texts]
            hashes, lengths = word_hashes(words)
            split = np.split(hashes.astype("<u4"), np.cumsum(lengths)[:-1])
            yield record_batch(
                digested,
                {
                    "doc_id": part.column("doc_id"),
                    "digest": [_digest(w) for w in words],
                    "n": lengths.tolist(),
                    "signature": [signature(h) for h in split],
                    "words": [h.tobytes() for h in split],
                },
            )

    # Texts stay in place, whatever their number: marks leave out almost all that are not wanted, and
    # only the words of the others are joined.
    wanted = wanted.withColumnRenamed("rep", "doc_id")
    return (
        rows.withColumn("at", F.pmod(F.xxhash64("doc_id"), F.lit(many)))
        .mapInArrow(run, digested)
        .join(wanted, ["doc_id", "digest"])
        .dropDuplicates(["node"])
        .select("node", "n", "signature", "words")
    )


PAIR = StructType([StructField("a", LongType()), StructField("b", LongType())])


def _plausible_pairs(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose signatures leave it open whether their texts are near."""

    def side(end: str) -> DataFrame:
        return texts.select(
            F.col("node").alias(end), F.col("n").alias(f"n_{end}"), F.col("signature").alias(f"s_{end}")
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            s_a, s_b = (signature_rows(batch.column(c)) for c in ("s_a", "s_b"))
            limit = edits_allowed(np.maximum(n_a, n_b), similarity)
            ones = np.maximum(*(np.bitwise_count(s).sum(1, dtype=np.int64) for s in (s_a, s_b)))
            common = np.bitwise_count(s_a & s_b).sum(1, dtype=np.int64)
            fine = pa.array((np.abs(n_a - n_b) <= limit) & (ones - common <= limit))
            yield record_batch(PAIR, {c: batch.column(c).filter(fine) for c in ("a", "b")})

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, PAIR)


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose texts are near."""
    left = texts.select(F.col("node").alias("a"), F.col("words").alias("words_a"))
    right = texts.select(F.col("node").alias("b"), F.col("words").alias("words_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            columns = (batch.column(c).to_pylist() for c in ("a", "b", "words_a", "words_b"))
            for a, b, words_a, words_b in zip(*columns):
                x, y = np.frombuffer(words_a, "<u4"), np.frombuffer(words_b, "<u4")
                allowed = int(max(len(x), len(y)) * (1 - similarity) + 1e-9)
                if words_apart(x, y) <= allowed and within(x, y, allowed):
                    kept.append((a, b))
            yield record_batch(PAIR, {"a": [p[0] for p in kept], "b": [p[1] for p in kept]})

    return pairs.join(left, "a").join(right, "b").mapInArrow(run, PAIR)


def whole_groups(
    batches: Iterator[pa.RecordBatch], by: list[str]
) -> Iterator[tuple[pa.RecordBatch, list[int]]]:
    """Batches of whole groups and where these begin and end, from batches sorted by group."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        held = batch if held is None else pa.concat_batches([held, batch])
        columns = [held.column(c).to_numpy() for c in by]
        change = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
        starts = [0, *(np.flatnonzero(change) + 1).tolist()]
        if len(starts) > 1:
            yield held.slice(0, starts[-1]), starts
            held = held.slice(starts[-1])
    if held is not None:
        yield held, [0, held.num_rows]


def _rest(
    members: DataFrame, texts: DataFrame, keys: DataFrame, similarity: float, written
) -> DataFrame:
    """Links between texts that share a bucket but no component, from blocks of each bucket.

    ``keys`` (node, keys) are the sketches of all texts.
    """
    bucket, by = Window.partitionBy("key"), ["key", "x", "y"]
    apart = members.withColumns(
        {
            "blocks": F.ceil(F.count("*").over(bucket) / F.lit(float(BLOCK))).cast("int"),
            "low": F.min("component").over(bucket), "high": F.max("component").over(bucket),
        }
    ).filter("low <> high")
    placed = apart.withColumn("own", F.pmod(F.xxhash64("node", "key"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = placed.withColumn("other", other).select(
        "key", "node", "component",
        F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
        (F.col("own") <= F.col("other")).alias("first"),
    )
    placed = written(placed, "blocks")
    schema = StructType([*(placed.schema[c] for c in by), *PAIR.fields])
    most = DENSE

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, edges in whole_groups(batches, by):
            signatures = signature_rows(part.column("signature"))
            n, component, x, y = (part.column(c).to_numpy() for c in ("n", "component", "x", "y"))
            first = part.column("first").to_numpy(zero_copy_only=False)
            groups, dense, left, right = [], [], [], []
            for start, end in zip(edges, edges[1:]):
                rows, lefts = np.arange(start, end), None
                if x[start] != y[start]:
                    lefts, rows = rows[first[start:end]], rows[~first[start:end]]
                    if not len(lefts) or not len(rows):
                        continue
                pair = proposed(signatures, n, component, rows, lefts, similarity, most)
                if pair is None:
                    dense.append(start)
                    continue
                groups.append(np.full(len(pair[0]), start))
                left.append(pair[0])
                right.append(pair[1])
            at = np.concatenate([*groups, np.array(dense, np.int64)]).astype(np.int64)
            nodes = part.column("node").to_numpy()
            nothing = pa.nulls(len(dense), pa.int64())
            ends = [nodes[np.concatenate([*side, np.zeros(0, np.int64)])] for side in (left, right)]
            columns = {c: part.column(c).take(pa.array(at)) for c in by}
            columns |= {
                c: pa.concat_arrays([pa.array(v), nothing])
                for c, v in (("a", np.maximum(*ends)), ("b", np.minimum(*ends)))
            }
            yield record_batch(schema, columns)

    signed = placed.join(texts.select("node", "n", "signature"), "node")
    found = written(
        signed.repartition(*by).sortWithinPartitions(*by).mapInArrow(propose, schema), "proposed"
    )
    links = _verified(found.filter("a IS NOT NULL").select("a", "b").distinct(), texts, similarity)
    dense = found.filter("a IS NULL").select(by)
    if dense.isEmpty():
        return links
    rows = placed.join(dense, by).join(texts.select("node", "words"), "node").join(keys, "node")

    def meet(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        sides = []
        for g in [group] if key[1] == key[2] else [group[group["first"]], group[~group["first"]]]:
            words = [np.frombuffer(w, "<u4") for w in g["words"]]
            sides.append(
                {
                    "bags": np.stack([bags(w) for w in words]).astype(np.int64),
                    "words": words,
                    "n": np.array([len(w) for w in words]),
                    "nodes": g["node"].tolist(),
                    "part": g["component"].to_numpy(np.int64),
                    "keys": np.stack(g["keys"].tolist()),
                }
            )
        links = _forest(sides[0], sides[-1], key[0], similarity)
        return pd.DataFrame(
            {"a": [max(p) for p in links], "b": [min(p) for p in links]}, dtype="int64"
        )

    more = rows.groupBy(*by).applyInPandas(meet, "a bigint, b bigint")
    return links.unionByName(more).distinct()


def _forest(left: dict, right: dict, key: int, similarity: float) -> list[tuple[int, int]]:
    """Links that connect what the texts of two blocks (or one, given twice) connect.

    A few texts of ``left``, then more at a time, meet what they are not connected to yet; of these
    the plausible pairs are aligned by ascending bag distance unless they are connected by then.
    """
    parts = {p for side in (left, right) for p in side["part"].tolist()}
    parent = {p: p for p in parts}

    def root(part: int) -> int:
        while parent[part] != part:
            parent[part] = parent[parent[part]]
            part = parent[part]
        return part

    def taken(side: dict, start: int, end: int | None = None) -> dict:
        """Some texts of a block, with the parts that are connected by now."""
        out = {name: column[start:end] for name, column in side.items()}
        return out | {"part": np.array([root(p) for p in out["part"].tolist()], np.int64)}

    links, start, step = [], 0, FIRST_STEP
    while start < len(left["nodes"]):
        a, b = taken(left, start, start + step), taken(right, start if right is left else 0)
        i, j, distance = plausible(a, b, key, similarity)
        parts_a, parts_b = a["part"].tolist(), b["part"].tolist()
        for k in np.argsort(distance, kind="stable").tolist():
            at, to = int(i[k]), int(j[k])
            x, y = root(parts_a[at]), root(parts_b[to])
            if x != y and near(a["words"][at], b["words"][to], similarity):
                parent[max(x, y)] = min(x, y)
                links.append((a["nodes"][at], b["nodes"][to]))
        start, step = start + step, min(2 * step, STEP)
    return links


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """Per document: key, class_id, kept.

    ``class_id`` is the smallest key of the documents connected by near-duplicate links, ``kept``
    whether it is the document's own. Words are lower-cased and split at white space. A null text is
    empty; texts without words are copies of each other. A text of fewer than 5 words is near to its
    copies only. A document with a null key links with nothing, has no class and is
    kept. Repeated rows share a class. An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession

    def written(df: DataFrame, name: str) -> DataFrame:
        folder = fresh_path(spark, name)
        df.write.parquet(folder)
        return spark.read.schema(df.schema).parquet(folder)

    rows = docs.select(docs[key].cast("bigint").alias("doc_id"), docs[text].alias("text"))
    known = rows.filter("doc_id IS NOT NULL")
    sketched = _sketched(known).withColumn("row", F.monotonically_increasing_id())
    sketched = written(sketched, "sketches")

    # One node per different text, the number of one of its rows. Only what is small is joined with
    # whole texts and their keys, which Spark may then leave in place.
    texts_of = written(
        sketched.groupBy("digest").agg(
            F.min("doc_id").alias("rep"), F.min("row").alias("node"), F.first("n_words").alias("n")
        ),
        "texts",
    )
    keys = sketched.select(F.col("row").alias("node"), "keys")
    worded = texts_of.filter("n > 0").select("node")
    buckets = keys.join(worded, "node", "left_semi").select("node", F.explode("keys").alias("key"))
    bucket = Window.partitionBy("key")
    lowest = F.min(F.struct(F.xxhash64("node"), F.col("node").alias("node"))).over(bucket)
    members = buckets.filter("key <> 0").withColumns(
        {"n": F.count("*").over(bucket), "leader": lowest["node"]}
    )
    members = written(members.filter("n > 1").select("key", "node", "leader"), "members")
    nodes = members.select("node").distinct()
    wanted = written(nodes.join(texts_of, "node").select("node", "rep", "digest"), "wanted")
    texts = written(_texts(known, wanted), "words")

    nodes = wanted.select("node")
    pairs = (
        members.filter("node <> leader")
        .select(F.greatest("node", "leader").alias("a"), F.least("node", "leader").alias("b"))
        .distinct()
    )
    pairs = _plausible_pairs(pairs, texts, similarity)
    links = written(_verified(pairs, texts, similarity), "links")
    assigned = _assigned(nodes, links, written)
    members = members.select("key", "node").join(assigned, "node")
    rest = _rest(members, texts, keys, similarity, written)
    links = links.unionByName(written(rest, "links"))
    assigned = _assigned(nodes, links, written)

    # Classes by the smallest id of all texts of a component.
    named = texts_of.select("node", "digest", "rep").join(assigned, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    smallest = named.groupBy("component").agg(F.min("rep").alias("class_id"))
    classes = named.join(smallest, "component").select("digest", "class_id")
    found = sketched.select("doc_id", "digest").join(classes, "digest")
    nameless = rows.filter("doc_id IS NULL").select(
        F.col("doc_id"), F.lit(None).cast("bigint").alias("class_id")
    )
    return (
        found.select("doc_id", "class_id")
        .unionByName(nameless)
        .select(
            F.col("doc_id").alias(key), "class_id",
            F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)).alias("kept"),
        )
    )


def _assigned(nodes: DataFrame, links: DataFrame, written) -> DataFrame:
    groups = components(links, "a", "b")
    return written(
        nodes.join(groups, "node", "left").select(
            "node", F.coalesce("component", "node").alias("component")
        ),
        "assigned",
    )
