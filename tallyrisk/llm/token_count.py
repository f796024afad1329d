"""Token counts by byte-pair merging with a heap and a linked list: initial symbols minus merges, no ids.

The rules are read from a public sentencepiece BPE model (its path is a parameter): pieces, scores, byte fallback, the blank put in front.
A text's symbols are its characters (blanks as U+2581).  A linked list holds them; a heap holds the adjacent pairs whose
joined text is a piece, best score first, then leftmost.  The best pair that is still as it was is popped and merged,
and its two new neighbour pairs enter the heap, until none is left.  A character that is no piece counts as its UTF-8 bytes (byte fallback) and never merges.
So the count of a text is its initial symbols minus its merges.

Two characters that stand side by side in no piece can never be merged across, so a text may be cut between them without changing a single
merge.  ``Counter`` cuts at blanks (where the model's pieces allow it) and then at all such places, and remembers the counts
of recurring stretches in a bounded cache; a stretch without such a place, however long, goes through the heap whole, in time n log n.

No shuffle: every text is counted where it is read.

Defined results: a null or empty text has 0 bytes and 0 tokens; rows are counted one by one, whatever their ids; other columns are kept, input columns
named as the results are replaced; empty tables give empty results.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LIMIT = 4096
CACHE = 400_000     # stretches, in each of two generations
BLANK = "▁"


class Merges:
    """What the counting needs of a sentencepiece BPE model."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb
        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec, norm, kind = model.trainer_spec, model.normalizer_spec, pb.ModelProto.SentencePiece
        if spec.model_type != pb.TrainerSpec.BPE or not spec.byte_fallback or spec.treat_whitespace_as_suffix:
            raise ValueError("token counts need a BPE model with byte fallback and blanks as prefixes")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("token counts need a model that leaves texts as they are")
        if any(p.type in (kind.UNUSED, kind.USER_DEFINED) for p in model.pieces):
            raise ValueError("token counts need a model without unused or user-defined pieces")
        self.prefix = BLANK if norm.add_dummy_prefix else ""
        #: piece -> its place in the order of merging (small is first; equal scores share a place)
        self.rank = {p.piece: -p.score for p in model.pieces if p.type == kind.NORMAL}
        self.pairs = {w[i:i + 2] for w in self.rank for i in range(len(w) - 1)}
        #: no piece holds a blank behind another character: texts fall apart in front of blanks
        self.at_blanks = not any(b == BLANK and a != BLANK for a, b in self.pairs)


class Counter(dict):
    """Counts of stretches (blanks as U+2581); a dictionary that fills itself, in two generations so that its size is bounded."""

    def __init__(self, merges: Merges):
        super().__init__()
        self.m = merges
        self.old: dict[str, int] = {}

    def text(self, text: str | None) -> int:
        if not text:
            return 0
        text = self.m.prefix + text.replace(" ", BLANK)
        if not self.m.at_blanks:
            return self[text]
        if text[0] == BLANK and text[-1] != BLANK and BLANK * 2 not in text:
            # single blanks only: stretches are told apart by having lost their blank
            return sum(map(self.__getitem__, text[1:].split(BLANK)))
        return sum(map(self._stretch, re.findall(f"{BLANK}*[^{BLANK}]+|{BLANK}+", text)))

    def _stretch(self, s: str) -> int:
        """``s`` with all its blanks in front."""
        if s[0] == BLANK and len(s) > 1 and s[1] != BLANK:
            return self[s[1:]]
        return self.parts(s)

    def __missing__(self, word: str) -> int:
        """``word`` without its one leading blank (with ``at_blanks``), or a whole text."""
        n = self.old.get(word)
        if n is None:
            n = self.parts(BLANK + word if self.m.at_blanks else word)
        if len(word) <= 64:
            if len(self) >= CACHE:
                self.old = dict(self)
                self.clear()
            self[word] = n
        return n

    def parts(self, s: str) -> int:
        """Cut where no piece reaches across, each part merged by itself."""
        pairs, at, n = self.m.pairs, 0, 0
        for i in range(1, len(s)):
            if s[i - 1:i + 1] not in pairs:
                n += merged(s[at:i], self.m.rank) if i - at > 1 else self.single(s[at])
                at = i
        return n + (merged(s[at:], self.m.rank) if len(s) - at > 1 else self.single(s[at]))

    def single(self, c: str) -> int:
        return 1 if c in self.m.rank else len(c.encode("utf-8"))


def merged(s: str, rank: dict[str, float]) -> int:
    """Symbols of ``s`` after all merges: the heap holds (place, left, middle, end), the list the next and previous symbol."""
    n = len(s)
    after = list(range(1, n + 2))
    before = list(range(-1, n))
    heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := rank.get(s[i:i + 2])) is not None]
    heapify(heap)
    count = n
    while heap:
        _, left, mid, end = heappop(heap)
        if after[left] != mid or after[mid] != end:
            continue    # one of the two was merged away meanwhile
        count -= 1
        after[left], after[mid] = end, -1
        if end < n:
            before[end] = left
            stop = after[end]
            if (r := rank.get(s[left:stop])) is not None:
                heappush(heap, (r, left, end, stop))
        if left:
            start = before[left]
            if (r := rank.get(s[start:end])) is not None:
                heappush(heap, (r, start, left, end))
    if not s.isascii():
        # initial symbols of characters that are no pieces are their bytes
        count += sum(len(c.encode("utf-8")) - 1 for c in s if c > "\x7f" and c not in rank)
    return count


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(Merges(path))


def count_tokens(docs: DataFrame, model: str, limit: int = LIMIT, column: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens)."""
    kept = docs.drop("n_bytes", "n_tokens", "over_limit")
    names = kept.columns
    at = names.index(column)
    schema = T.StructType([*kept.schema.fields, T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(model).text
        for batch in batches:
            n = pa.array([count(t.as_py()) for t in batch.column(at)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, n], names=[*names, "n_tokens"])

    return (kept.mapInArrow(run, schema)
            .withColumns({"n_bytes": F.coalesce(F.octet_length(column).cast("long"), F.lit(0)), "over_limit": F.col("n_tokens") > limit}))
