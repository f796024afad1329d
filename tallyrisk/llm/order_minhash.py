"""MinHash near-dedup with Order MinHash sketches and banded alignment.

Words are runs of letters and digits in lower case (white-space runs where a text has none).  Shingles are five words; a shorter text
is one shingle.  Equal shingles of a text are told apart by their occurrence number.

* **Sketch.**  Each of ``BANDS * ROWS`` hash functions picks the ``PICKS`` labelled shingles of smallest hash; the sketch value is a
  hash of the picked shingles *in text order*.  So texts agree in a sketch value if they share the same smallest shingles and have
  them in the same order, which follows edit similarity rather than set similarity.  ``ROWS`` values make a band.
* **Classes.**  Texts of equal words are one class, named by its smallest doc_id; only classes are compared.
* **Candidates.**  Classes that agree in a band share a bucket.  First every member meets the bucket's smallest member only; the
  verified links give components.  Buckets that still hold two components are then searched whole, in blocks of about ``BLOCK`` members or ``BLOCK_WORDS``
  words (a hot bucket becomes many block pairs): a task gets the words of one block pair, counts the words and two-word shingles that its pairs
  share, and aligns those that pass the bound, most alike first, skipping pairs whose members are joined by then.  A pair is looked at in the first band it
  agrees in only.  Pairs never become rows: a task returns at most one link less than it has members, and no candidate between different components is left out.
* **Verification.**  The words of bucket members, and of no other text, are moved.  The similarity is ``1 - edits / words of the longer text``, where
  edits are the least word insertions, deletions and substitutions that turn one text into the other (alignment by furthest-reaching diagonals, inside the band of
  diagonals that the threshold leaves, in space linear in the edits).  ``threshold`` (0.8) or more is a link.  An edit breaks at most one word and two
  two-word shingles, so texts of threshold similarity share at least ``words - edits`` and ``words - 1 - 2 * edits`` of them: pairs with fewer are not aligned.  A five-word shingle similarity of 0.8 or more in
  the same order implies a similarity of 0.8 or more here; scattered edits, each of which costs five shingles, weigh one word.
* **Groups** are the connected components of the links.

Two texts whose five-word shingles have the Jaccard index J and one order agree in a sketch value with probability of about J * J.  So a pair is found
with probability of about ``1 - (1 - J ** 2) ** 32``: over 0.9999 from J = 0.5 on, 0.998 for one scattered edit in ten words, 0.93 for 15 in a hundred, 0.7 for the
worst pair at the threshold (one edit in every five words, which leaves J = 0.2).

Defined results: null texts and texts without words are never linked; rows with null doc_id are not compared and have a null class;
rows with equal doc_id share the smallest class of any of their texts; empty tables give empty results; other columns are ignored.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, column, list_column, row_groups
from .components import connected_components

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 32
ROWS = 1
PICKS = 2
BOUNDS = (1, 2)        # words of the shingles counted before an alignment
BLOCK = 256            # members of a block
BLOCK_WORDS = 2_000_000
TOGETHER = 64          # pairs aligned at once
TOGETHER_WORDS = 200_000
STAR = 1024            # pairs of one centre that share a copy of its words
BATCH = 4 << 20        # bytes of rows that a task hands to Python at a time
SEED = 7321

_RNG = np.random.default_rng(SEED)
_ODD = _RNG.integers(0, 2**63, size=(SHINGLE + BANDS * ROWS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP, _FUNCTIONS = _ODD[:SHINGLE, 0], _ODD[SHINGLE:]


_WORD = re.compile(r"[^\W_]+")
CACHE_WORDS = 50_000


class _Hashes(dict):
    """32-bit hashes of words; the cache of recurring words is bounded."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh32_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


_HASHES = _Hashes()


def words(text: str | None) -> np.ndarray:
    """Hashes (int32) of a text's words."""
    low = (text or "").lower()
    found = _WORD.findall(low) or low.split()
    return np.array(list(map(_HASHES.__getitem__, found)), dtype=np.uint32).view(np.int32)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(w: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """64-bit hashes of the shingles of ``size`` (five) words of word hashes."""
    w = w.astype(np.int64).view(np.uint64)
    k = min(size, len(w))
    out = w[:len(w) - k + 1] * _STEP[0]
    for j in range(1, k):
        out = out + w[j:len(w) - k + 1 + j] * _STEP[j]
    return _mix(out + np.uint64(k))


def labelled(s: np.ndarray) -> np.ndarray:
    """Shingles made distinct by their occurrence number."""
    order = np.argsort(s, kind="stable")
    o = s[order]
    same = np.zeros(len(s), dtype=bool)
    same[1:] = o[1:] == o[:-1]
    if not same.any():
        return s
    at = np.arange(len(s))
    nth = at - np.maximum.accumulate(np.where(same, 0, at))
    out = s.copy()
    # a first occurrence keeps its hash, whether or not the text repeats any other
    out[order] = np.where(nth > 0, _mix(o + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), o)
    return out


def sketch(w: np.ndarray) -> np.ndarray:
    """Order MinHash values (uint64) of one text's word hashes."""
    s = shingles(w)
    lab = labelled(s)
    n, m = len(_FUNCTIONS), len(s)
    picks = np.empty((n, min(PICKS, m)), dtype=np.int64)
    step = max(1, (1 << 18) // m)
    for at in range(0, n, step):
        v = lab[None, :] * _FUNCTIONS[at:at + step]
        v ^= v >> np.uint64(32)
        rows = np.arange(len(v))
        for p in range(picks.shape[1]):
            best = v.argmin(axis=1)
            picks[at:at + step, p] = best
            v[rows, best] = np.uint64(2**64 - 1)
    picks.sort(axis=1)
    out = np.zeros(n, dtype=np.uint64)
    for p in range(picks.shape[1]):
        out = _mix(out + s[picks[:, p]])
    return out


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, class key, number of words, band keys and words (hashes) of every text that has words."""
    salt = _mix(np.arange(1, BANDS + 1, dtype=np.uint64))
    for whole in batches:
        for at in range(0, whole.num_rows, 1024):
            batch = whole.slice(at, 1024)
            ids, keys, sizes, bands, hashes = [], [], [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                w = words(text.as_py())
                if not len(w):
                    continue
                v = sketch(w)
                key = salt.copy()
                for r in range(ROWS):
                    key = _mix(key + v[r::ROWS])
                ids.append(doc_id)
                hashes.append(w.tobytes())
                keys.append(xxhash.xxh3_128_digest(hashes[-1]))
                sizes.append(len(w))
                bands.append(key.view(np.int64))
            if ids:
                k = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(k[:, 0]), pa.array(k[:, 1]), pa.array(sizes, pa.int64()),
                     pa.ListArray.from_arrays(np.arange(len(ids) + 1, dtype=np.int32) * BANDS, pa.array(np.concatenate(bands))),
                     pa.array(hashes, pa.binary())],
                    names=["doc_id", "k1", "k2", "size", "bands", "words"])


# ------------------------------------------------------------------ verification

def most_edits(words: int, threshold: float) -> int:
    """Edits that a longer text of so many words may have."""
    return int((1 - threshold) * words + 1e-9)


def least_shared(words: int, size: int, threshold: float) -> int:
    """Shingles of ``size`` words that it then shares at least: an edit breaks ``size`` of them at most."""
    return words - size + 1 - size * most_edits(words, threshold)


def aligned_similarity(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> float:
    """1 - least edits / words of the longer text; 0 if below ``threshold``."""
    n = max(len(a), len(b))
    if not len(a) or not len(b):
        return 0.0
    if not enough_shared(a, b, threshold):
        return 0.0
    d = edits(a, b, most_edits(n, threshold))
    return 0.0 if d is None else 1 - d / n


_NONE = -(1 << 40)


def edits(a: np.ndarray, b: np.ndarray, most: int) -> int | None:
    """Least edits between two word sequences, None if above ``most``: furthest-reaching diagonals, ``most`` numbers of memory."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    head = int(differ[0]) if len(differ) else n
    a, b = a[head:], b[head:]
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[len(a) - n:][::-1] != b[len(b) - n:][::-1])
    tail = int(differ[0]) if len(differ) else n
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    la, lb, goal = len(a), len(b), len(b) - len(a)
    if abs(goal) > most:
        return None
    if not la or not lb:
        return max(la, lb)
    # each ends with a mark that nothing equals
    a, b = np.append(a.astype(np.int64), 1 << 40), np.append(b.astype(np.int64), 1 << 41)
    zero = most + 1                      # place of diagonal 0 (place in b minus place in a)
    reach = np.full(2 * most + 3, _NONE, np.int64)
    for d in range(most + 1):
        # only diagonals from which the goal can still be reached
        lo, hi = max(-d, -la, goal - (most - d)), min(d, lb, goal + (most - d))
        if lo > hi:
            return None
        k = np.arange(lo, hi + 1)
        if d:
            at = slice(zero + lo, zero + hi + 1)
            i = np.maximum(np.maximum(reach[at] + 1, reach[zero + lo - 1:zero + hi]), reach[zero + lo + 1:zero + hi + 2] + 1)
            i = np.minimum(i, np.minimum(la, lb - k))
        else:
            i = np.zeros(1, np.int64)
        on = np.flatnonzero((i >= 0) & (i + k >= 0))
        for _ in range(8):
            on = on[a[i[on]] == b[i[on] + k[on]]]
            if not len(on):
                break
            i[on] += 1
        for x in on:                     # long runs, one by one
            i[x] += _run(a, b, int(i[x]), int(i[x] + k[x]))
        i[(i < 0) | (i + k < 0)] = _NONE
        reach[:] = _NONE
        reach[zero + lo:zero + hi + 1] = i
        if lo <= goal <= hi and i[goal - lo] >= la:
            return d
    return None


def _run(a: np.ndarray, b: np.ndarray, i: int, j: int) -> int:
    """Length of the common run at a[i], b[j]; the end marks differ from everything."""
    n, step = 0, 64
    while True:
        m = min(step, len(a) - i - n, len(b) - j - n)
        differ = np.flatnonzero(a[i + n:i + n + m] != b[j + n:j + n + m])
        if len(differ):
            return n + int(differ[0])
        n, step = n + m, step * 2


def enough_shared(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    """Whether two texts share the words and shingles that the threshold asks for."""
    n = max(len(a), len(b))
    return all(min(len(a), len(b)) < k or len(np.intersect1d(labelled(shingles(a, k)), labelled(shingles(b, k)), assume_unique=True))
               >= least_shared(n, k, threshold) for k in BOUNDS)


def edits_many(pairs: list[tuple[np.ndarray, np.ndarray]], most: list[int]) -> np.ndarray:
    """``edits`` of several pairs at once, -1 where it is above ``most``: a row of diagonals for each pair, all advanced together."""
    out = np.full(len(pairs), -1, np.int64)
    la, lb = (np.array([len(p[i]) for p in pairs], np.int64) for i in (0, 1))
    most = np.asarray(most, np.int64)
    # all texts end to end, each behind it a mark that nothing equals
    flat_a = np.concatenate([x for p in pairs for x in (p[0].astype(np.int64), [1 << 40])])
    flat_b = np.concatenate([x for p in pairs for x in (p[1].astype(np.int64), [1 << 41])])
    at_a, at_b = (np.concatenate([[0], np.cumsum(n + 1)[:-1]]) for n in (la, lb))
    goal, who = lb - la, np.arange(len(pairs))
    keep = np.abs(goal) <= most
    la, lb, at_a, at_b, goal, who, most = (x[keep] for x in (la, lb, at_a, at_b, goal, who, most))
    zero = int(most.max(initial=0)) + 1
    reach = np.full((len(who), 2 * zero + 1), _NONE, np.int64)
    d = 0
    while len(who):
        k = np.arange(-d, d + 1)
        if d:
            at = slice(zero - d, zero + d + 1)
            i = np.maximum(np.maximum(reach[:, at], reach[:, zero + 1 - d:zero + d + 2]) + 1, reach[:, zero - 1 - d:zero + d])
            i = np.minimum(i, np.minimum(la[:, None], lb[:, None] - k))
        else:
            i = np.zeros((len(who), 1), np.int64)
        left = (most - d)[:, None]
        i[(i < 0) | (i + k < 0) | (k < goal[:, None] - left) | (k > goal[:, None] + left)] = _NONE
        row, col = np.nonzero(i >= 0)
        n, x, y = 0, at_a[row] + i[row, col], at_b[row] + i[row, col] + k[col]
        while len(row):
            same = flat_a[x] == flat_b[y]
            row, col, x, y = row[same], col[same], x[same] + 1, y[same] + 1
            i[row, col] += 1
            n += 1
            if n == 16:      # long runs, one by one
                for r, c, u, v in zip(row.tolist(), col.tolist(), x.tolist(), y.tolist()):
                    i[r, c] += _run(flat_a, flat_b, u, v)
                break
        reach[:, zero - d:zero + d + 1] = i
        here = np.abs(goal) <= d
        done = here & (i[np.arange(len(who)), np.where(here, goal + d, 0)] >= la)
        out[who[done]] = d
        d += 1
        on = ~done & (most >= d)
        if not on.all():
            la, lb, at_a, at_b, goal, who, most, reach = (z[on] for z in (la, lb, at_a, at_b, goal, who, most, reach))
    return out


def _verified(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                pairs = [tuple(np.frombuffer(x.as_buffer(), np.int32) for x in p) for p in zip(batch.column("wa"), batch.column("wb"))]
                ok = np.array([enough_shared(a, b, threshold) for a, b in pairs], bool)
                some = np.flatnonzero(ok)
                for part in _parts(some, pairs):
                    ok[part] = edits_many([pairs[i] for i in part], [most_edits(max(map(len, pairs[i])), threshold) for i in part]) >= 0
                keep = pa.array(ok)
                yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])
    return run


def _parts(which: np.ndarray, pairs: list) -> Iterator[np.ndarray]:
    """Runs of ``which`` that are aligned together: at most ``TOGETHER`` pairs, fewer of long texts."""
    part, total = [], 0
    for i in which.tolist():
        n = max(map(len, pairs[i]))
        if part and (len(part) == TOGETHER or total + n > TOGETHER_WORDS):
            yield np.array(part)
            part, total = [], 0
        part.append(i)
        total += n
    if part:
        yield np.array(part)


# ------------------------------------------------------------------ blocks

def _marks(texts: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, texts that have it) of the labelled shingles of ``size`` words that two texts have, by shingle."""
    marks = [labelled(shingles(w, size)) if len(w) >= size else np.zeros(0, np.uint64) for w in texts]
    row = np.repeat(np.arange(len(texts)), [len(m) for m in marks])
    _, col, seen = np.unique(np.concatenate(marks), return_inverse=True, return_counts=True)
    again = seen > 1
    keep = again[col]
    row, col = row[keep], (np.cumsum(again) - 1)[col[keep]]
    order = np.argsort(col, kind="stable")
    return row[order], col[order], seen[again]


def shared_shingles(texts: list[np.ndarray], size: int, pairs: np.ndarray) -> np.ndarray:
    """How many labelled shingles of ``size`` words the texts of the pairs (matrix mask, upper half) share, counted over bit rows."""
    row, col, seen = _marks(texts, size)
    out = np.zeros(pairs.shape, np.int32)
    width = 1 << 14
    for low in range(0, len(seen), width):
        x, y = np.searchsorted(col, [low, low + width])
        part = np.zeros((len(texts), width), bool)
        part[row[x:y], col[x:y] - low] = True
        bits = np.packbits(part, axis=1).view(np.uint64)
        for i in np.flatnonzero(pairs.any(axis=1)):
            j = np.flatnonzero(pairs[i])
            out[i, j] += np.bitwise_count(bits[j] & bits[i]).sum(axis=1, dtype=np.int32)
    return out


def sharing(texts: list[np.ndarray], threshold: float) -> np.ndarray:
    """Mask of the pairs that can share enough two-word shingles (prefix filter).

    Who shares at least t of its n shingles with another shares one of its n - t + 1 rarest with that one's rarest."""
    n = len(texts)
    size = np.array([len(w) for w in texts])
    row, col, seen = _marks(texts, 2)
    # by text, rarest first; shingles that no other text has come before all of these
    order = np.lexsort((col, seen[col], row))
    row, col = row[order], col[order]
    own = np.maximum(size - 1, 0) - np.bincount(row, minlength=n)
    place = np.arange(len(row)) - np.searchsorted(row, np.arange(n))[row]
    rare = np.maximum(size - 1, 0) - np.array([least_shared(int(x), 2, threshold) for x in size]) + 1
    keep = place < (rare - own)[row]
    row, col = row[keep], col[keep]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    out = np.zeros((n, n), bool)
    for x in np.split(row, np.flatnonzero(np.diff(col)) + 1):
        if len(x) > 1:
            out[x[:, None], x] = True
    # texts that may share none at all
    out |= np.logical_or.outer(rare > np.maximum(size - 1, 0), rare > np.maximum(size - 1, 0))
    return out


def block_links(ids: np.ndarray, label: np.ndarray, home: np.ndarray, band: int, bands: np.ndarray, texts: list[np.ndarray],
                threshold: float) -> list[tuple[int, int]]:
    """Links between the components of one block pair that share bucket ``band``: a spanning forest, most alike first."""
    n = len(ids)
    apart = np.not_equal.outer(label, label)
    if home.min() != home.max():
        apart &= np.not_equal.outer(home, home)     # pairs of one block are another task's
    for c in range(band):
        apart &= np.not_equal.outer(bands[:, c], bands[:, c])   # met in an earlier band
    if not apart.any():
        return []
    size = np.array([len(w) for w in texts])
    longer = np.maximum.outer(size, size)
    # the same bounds as aligned_similarity
    most = ((1 - threshold) * longer + 1e-9).astype(np.int64)
    apart &= (np.abs(np.subtract.outer(size, size)) <= most) & sharing(texts, threshold)
    apart = np.triu(apart, 1)
    for k in BOUNDS:
        if not apart.any():
            return []
        shared = shared_shingles(texts, k, apart)
        apart &= (shared >= longer - k + 1 - k * most) | (np.minimum.outer(size, size) < k)
    i, j = np.nonzero(apart)
    order = np.lexsort((ids[j], ids[i], -(shared[i, j] / longer[i, j])))
    i, j = i[order], j[order]
    parent = {int(x): int(x) for x in label}

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    while True:
        tops = np.array([top(int(x)) for x in label])
        open_ = tops[i] != tops[j]
        i, j = i[open_], j[open_]
        if not len(i):
            return out
        pairs = list(zip((texts[x] for x in i[:TOGETHER]), (texts[x] for x in j[:TOGETHER])))
        part = next(_parts(np.arange(len(pairs)), pairs))
        d = edits_many([pairs[x] for x in part], [int(most[i[x], j[x]]) for x in part])
        for x in part[d >= 0]:
            a, b = top(int(label[i[x]])), top(int(label[j[x]]))
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((int(ids[i[x]]), int(ids[j[x]])))
        i, j = i[len(part):], j[len(part):]


def _searched(threshold: float):
    """Over rows sorted by block pair and id: the links of every block pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, starts in row_groups(batches, ["bucket", "lo", "hi"]):
            ids, label, home = (column(whole, k) for k in ("id", "label", "home"))
            bucket = column(whole, "bucket")
            values, ends = list_column(whole, "bands")
            words_ = whole.column("words")
            for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
                if e - s < 2 or (label[s:e] == label[s]).all():
                    continue
                bands = values[ends[s]:ends[e]].reshape(e - s, -1)
                band = int(np.flatnonzero(bands[0] == bucket[s])[0])
                texts = [np.frombuffer(x.as_buffer(), np.int32) for x in words_[s:e]]
                links = block_links(ids[s:e], label[s:e], home[s:e], band, bands, texts, threshold)
                if links:
                    a, b = zip(*links)
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return run


# ------------------------------------------------------------------ whole table

def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id (smallest doc_id of its group), kept: one row for each row of ``docs``."""
    scratch = Scratch(docs.sparkSession, "order-minhash")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id IS NOT NULL")
    sketches = scratch.write(texts.mapInArrow(_sketched, "doc_id long, k1 long, k2 long, size long, bands array<long>, words binary"),
                             "sketches", BATCH)
    # what is aggregated is written before it is joined back, so that a hot key's rows can be split there
    copies = scratch.write(sketches.groupBy("k1", "k2").agg(F.min("doc_id").alias("id"), F.count("*").alias("n"))
                           .filter("n > 1").drop("n"), "copies")
    named = scratch.write(sketches.select("doc_id", "k1", "k2").join(copies, ["k1", "k2"], "left")
                          .select("doc_id", F.coalesce("id", "doc_id").alias("id")).distinct(), "classes")
    reps = scratch.write(sketches.join(named.filter("doc_id = id").select("doc_id"), "doc_id", "left_semi")
                         .dropDuplicates(["doc_id", "k1", "k2"]).select(F.col("doc_id").alias("id"), "size", "bands"), "reps")
    scratch.drop("copies")
    in_band = reps.select("id", "size", F.explode("bands").alias("bucket"))
    shared = scratch.write(in_band.groupBy("bucket").agg(F.min("id").alias("centre"), F.count("*").alias("n"), F.sum("size").alias("size"))
                           .filter("n > 1"), "shared")
    members = scratch.write(in_band.drop("size").join(shared, "bucket"), "members")
    # texts are cut into words once, with their sketches; of these only the members' words are moved
    # (a merge join at every size: whether the ids fit a broadcast must not change what is shuffled)
    in_any = members.select(F.col("id").alias("doc_id")).distinct().hint("merge")
    moved = scratch.write(sketches.select("doc_id", "words").join(in_any, "doc_id", "left_semi"), "words")
    scratch.drop("sketches")
    links = scratch.write(_star_pairs(members, shared, moved).mapInArrow(_verified(threshold), "a long, b long"), "star", BATCH)
    label = scratch.write(connected_components(links, scratch, "cc-star"), "label")
    rest = scratch.write(_unsettled(members, label), "rest")
    if rest.limit(1).count():
        found = scratch.write(_block_pairs(rest, reps, moved).mapInArrow(_searched(threshold), "a long, b long"), "blocks", BATCH)
        label = connected_components(links.unionByName(found), scratch, "cc")
    # a document's group: that of its class; the class is named by its smallest doc_id, so is the component
    groups = (named.join(label.withColumnRenamed("node", "id"), "id", "left").groupBy("doc_id")
              .agg(F.min(F.coalesce("component", "id")).alias("class_id")))
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(groups, "doc_id", "left")
            .withColumn("class_id", F.coalesce("class_id", "doc_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True))))


def _star_pairs(members: DataFrame, shared: DataFrame, moved: DataFrame) -> DataFrame:
    """(a, b, wa, wb): every member with its bucket's centre.  A centre of many pairs is there once for every ``STAR`` of them."""
    salts = F.ceil(F.col("n") / STAR).cast("int")
    pairs = (members.filter("id <> centre").groupBy(F.col("centre").alias("a"), F.col("id").alias("b")).agg(F.min("n").alias("n"))
             .select("a", "b", F.pmod(F.xxhash64("b"), salts).cast("int").alias("salt")))
    centres = (shared.groupBy(F.col("centre").alias("doc_id")).agg(F.max("n").alias("n"))
               .join(moved, "doc_id").select(F.col("doc_id").alias("a"), F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"),
                                             F.col("words").alias("wa")))
    return (pairs.join(moved.select(F.col("doc_id").alias("b"), F.col("words").alias("wb")), "b")
            .join(centres.hint("merge"), ["a", "salt"]).select("a", "b", "wa", "wb"))


def _unsettled(members: DataFrame, label: DataFrame) -> DataFrame:
    """Members (with their component) of the buckets that hold two components or more."""
    at = (members.join(label.withColumnRenamed("node", "id"), "id", "left")
          .select("bucket", "id", "n", "size", F.coalesce("component", "id").alias("label")))
    open_ = at.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x <> y").select("bucket")
    return at.join(open_, "bucket")


def _block_pairs(rest: DataFrame, reps: DataFrame, moved: DataFrame) -> DataFrame:
    """Members with their words, once for every block pair they are in, together and in order."""
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("size") / BLOCK_WORDS)).cast("int")
    words_ = moved.join(reps.select(F.col("id").alias("doc_id"), "bands"), "doc_id").withColumnRenamed("doc_id", "id")
    return (rest.join(words_, "id")
            .withColumn("home", F.pmod(F.xxhash64("id", "bucket"), blocks).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .withColumns({"lo": F.least("home", "other"), "hi": F.greatest("home", "other")})
            .select("bucket", "lo", "hi", "home", "id", "label", "bands", "words")
            .repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi", "id"))
