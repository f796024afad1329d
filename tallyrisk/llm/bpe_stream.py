"""BPE encoding and decoding as streaming transducers with bounded lookahead.

``lookahead`` computes from the merge list how far to the right the tokenisation of a place can depend on what follows: a
missing right context first changes the pair that crosses the end of the text read so far, and the change moves left only through a merge of
later rank whose right part begins where the change begins.  Following all such chains in rank order gives a bound in
symbols.  ``Transducer`` therefore keeps a window: tokens that end more than the bound before the end of the window are stable
and are emitted, and the next window starts behind them (any run of tokens of a BPE tokenisation is the tokenisation of its own text).
Memory is constant however long a word or a text is; texts are fed in pieces of ``PIECE`` characters.

Around that core stands what the tokenizer file describes: special strings are taken out first, text is put into NFC, white space
separates, letters are lower-cased, the splitting pattern cuts words, bytes become symbols, and the last symbol of a word carries the end mark.  Words
recur, so ids of words up to ``CACHED`` characters are kept in a cache of bounded size.

``Decoder`` is the way back, also fed piece by piece: either the file's own decoding (a file that names no decoder joins token
strings by spaces) or ``text=True``, a byte-to-text state machine that holds an unfinished UTF-8 character and the pending word end.

Defined results: a null text is the empty text and has no ids; an empty table gives an empty result; all columns are kept, and
input columns named ``ids`` or ``decoded`` are replaced; ids that are not in the vocabulary are skipped when decoding.
"""
from __future__ import annotations

import codecs
import json
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import list_column

PIECE = 1 << 16
CACHED = 48
CACHE_WORDS = 300_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if printable, else one from 256 on in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(rest)) for b in range(256)]


@lru_cache(maxsize=1)
def _joins_left() -> frozenset[str]:
    """Starters that may compose with the character before them: no text may be cut in front of them."""
    seconds = {chr(c) for c in [*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]}
    for c in range(0x110000):
        parts = unicodedata.decomposition(chr(c)).split()
        if len(parts) == 2 and parts[0][0] != "<":
            seconds.add(chr(int(parts[1], 16)))
    return frozenset(seconds)


def lookahead(merges: list[tuple[str, str]], size) -> int:
    """Symbols of right context after which a token is stable; ``size``: symbols of a token."""
    made: dict[str, tuple[str, str]] = {}
    reach_of_left: dict[str, int] = {}
    most = 1
    for x, y in merges:
        made.setdefault(x + y, (x, y))
    for x, y in merges:
        reach, start = size(y), y
        while True:  # merges that begin where the right part begins, at any stage of its making
            reach = max(reach, reach_of_left.get(start, 0))
            if start not in made:
                break
            start = made[start][0]
        reach += size(x)
        reach_of_left[x] = max(reach_of_left.get(x, 0), reach)
        most = max(most, reach)
    return most


class Vocabulary:
    """What a tokenizer file says: ids, merge ranks, special strings, the splitting pattern and the end mark."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"] or ""
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.ranks = {m: i for i, m in enumerate(merges)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        steps = spec["pre_tokenizer"]["pretokenizers"]
        self.pattern = regex.compile(steps[0]["pattern"]["Regex"])
        self.space = regex.compile(r"\p{White_Space}+")
        self.joined = spec["decoder"] is None
        self.symbols = byte_symbols()
        self.table = {c: b for b, c in enumerate(self.symbols)}
        self.lookahead = lookahead(merges, self.size)
        self.marks = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

    def size(self, token: str) -> int:
        return len(token) - (len(self.end) if self.end and token.endswith(self.end) else 0)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


_NONE = 1 << 60


def merge(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """Greedy BPE: the pair of lowest rank first, the leftmost of equal ones."""
    if len(symbols) > 48:
        return _merge_long(symbols, ranks)
    rank = ranks.get
    order = [rank(pair, _NONE) for pair in zip(symbols, symbols[1:])]
    while order:
        best = min(order)
        if best == _NONE:
            break
        i = order.index(best)
        symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]
        del order[i]
        if i < len(order):
            order[i] = rank((symbols[i], symbols[i + 1]), _NONE)
        if i:
            order[i - 1] = rank((symbols[i - 1], symbols[i]), _NONE)
    return symbols


def _merge_long(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """The same with a heap and a linked list."""
    n = len(symbols)
    nxt, prev, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap = [(r, i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (r := ranks.get((symbols[i], symbols[i + 1]))) is not None]
    heapify(heap)
    while heap:
        _, i, a, b = heappop(heap)
        j = nxt[i]
        if not alive[i] or j >= n or symbols[i] != a or symbols[j] != b:
            continue
        symbols[i], alive[j] = a + b, False
        nxt[i] = nxt[j]
        if nxt[j] < n:
            prev[nxt[j]] = i
        for p, q in ((prev[i], i), (i, nxt[i])):
            if p >= 0 and q < n and (r := ranks.get((symbols[p], symbols[q]))) is not None:
                heappush(heap, (r, p, symbols[p], symbols[q]))
    return [s for s, ok in zip(symbols, alive) if ok]


class Word:
    """Transducer of one word: symbols in, stable ids out."""

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.window, self.held = vocab, [], 4 * vocab.lookahead

    def feed(self, symbols: str) -> list[int]:
        out: list[int] = []
        step = self.held
        for at in range(0, len(symbols), step):
            self.window += symbols[at:at + step]
            if len(self.window) < 2 * self.vocab.lookahead:
                continue
            left, n = len(self.window), 0
            for token in merge(self.window[:], self.vocab.ranks):
                size = len(token)
                if left - size < self.vocab.lookahead + 1:
                    break
                out.append(self.vocab.ids[token])
                left -= size
                n += size
            del self.window[:n]
        return out

    def finish(self) -> list[int]:
        if not self.window:
            return []
        self.window[-1] += self.vocab.end
        out = [self.vocab.ids[t] for t in merge(self.window, self.vocab.ranks)]
        self.window = []
        return out


#: runs of one class that a splitting pattern of this kind takes as one word, however long
RUNS = (regex.compile(r"\p{L}+"), regex.compile(r"[^\s\p{L}\p{N}]+"))


class Transducer:
    """Text in pieces in, ids (as arrays of C ints) out; holds back only what is not yet decided."""

    def __init__(self, vocab: Vocabulary, cache: tuple[dict[str, bytes], dict[str, list[int]]]):
        self.vocab, (self.cache, self.parts), self.rest = vocab, cache, ""
        self.hold = max(map(len, vocab.special), default=1)
        self.open: Word | None = None     # an endless word under way, and the class of its characters
        self.run = None

    def feed(self, piece: str, last: bool = False) -> Iterator[bytes]:
        text, self.rest = self.rest + piece, ""
        while self.vocab.marks is not None and (m := self.vocab.marks.search(text)):
            yield from self._plain(text[:m.start()], True)
            yield array("i", [self.vocab.special[m[0]]]).tobytes()
            text = text[m.end():]
        yield from self._plain(text, last)

    def _plain(self, text: str, last: bool) -> Iterator[bytes]:
        """Words of a text without special strings; an unfinished end is held back unless it is the last piece."""
        if self.open is not None:
            text = yield from self._go_on(text, last)
        if not last:
            # the last word may go on, and so may the beginning of a special string
            cut = self._begun(text)
            while cut and not text[cut - 1].isspace():
                cut -= 1
            if len(text) - cut > PIECE:      # one word longer than a piece goes on as a stream of its own
                yield from self._long(text)
                return
            text, self.rest = text[:cut], text[cut:] + self.rest
        words = text.split()
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            words = [w for w in self.vocab.space.split(text) if w]
        if words:
            yield self._words(words)

    def _begun(self, text: str) -> int:
        """Where a special string begins that the end of the text leaves open; the text's length if none does."""
        for k in range(min(self.hold - 1, len(text)), 0, -1):
            if any(s.startswith(text[-k:]) for s in self.vocab.special):
                return len(text) - k
        return len(text)

    def _words(self, words: list[str]) -> bytes:
        cache = self.cache
        out = list(map(cache.get, words))
        if None in out:
            for i, got in enumerate(out):
                if got is None:
                    w = words[i]
                    if (got := cache.get(w)) is None:
                        got = array("i", self._encode(w)).tobytes()
                        if len(w) <= CACHED:
                            if len(cache) >= CACHE_WORDS:
                                cache.clear()
                            cache[w] = got
                    out[i] = got
        return b"".join(out)

    def _normal(self, raw: str) -> str:
        text = raw if raw.isascii() else unicodedata.normalize("NFC", raw)
        return text.replace("Σ", "σ").lower()   # letter by letter: no final form of sigma

    def _encode(self, raw: str) -> list[int]:
        """Ids of one run without white space."""
        out: list[int] = []
        v = self.vocab
        for word in v.pattern.findall(self._normal(raw)):
            got = self.parts.get(word)
            if got is None:
                if len(word) <= v.lookahead:
                    marked = list(self._symbols(word))
                    marked[-1] += v.end
                    got = list(map(v.ids.__getitem__, merge(marked, v.ranks)))
                else:
                    got = self._word(word)
                if len(word) <= CACHED:
                    if len(self.parts) >= CACHE_WORDS:
                        self.parts.clear()
                    self.parts[word] = got
            out += got
        return out

    def _long(self, text: str) -> Iterator[bytes]:
        """Decided part of an endless word: whole words of the splitting pattern but for the last of the text read so far.

        The last two words are held back, since what follows may still change them.
        """
        head, tail = self._safe(text)
        norm = self._normal(head)
        found = list(self.vocab.pattern.finditer(norm))
        word = found[-1][0] if found else ""
        keep = found[-2].start() if len(found) > 2 else 0
        if len(word) > PIECE // 2 and (run := next((r for r in RUNS if r.fullmatch(word)), None)):
            yield array("i", [i for m in found[:-1] for i in self._word(m[0])]).tobytes()
            self.open, self.run = Word(self.vocab), run
            yield array("i", self.open.feed(self._symbols(word))).tobytes()
            self.rest = tail
        elif keep:
            yield array("i", [i for m in found[:-2] for i in self._word(m[0])]).tobytes()
            self.rest = norm[keep:] + tail
        else:
            self.rest = text

    def _safe(self, text: str) -> tuple[str, str]:
        """The text cut where neither a special string nor a composed character can be open."""
        cut = min(len(text) - 1, self._begun(text))
        while cut > 0 and (unicodedata.combining(text[cut]) or text[cut] in _joins_left()):
            cut -= 1
        return text[:max(cut, 0)], text[max(cut, 0):]

    def _go_on(self, text: str, last: bool) -> Iterator[bytes]:
        """Feeds the endless word; returns the text that follows it (empty while it goes on)."""
        head, tail = (text, "") if last else self._safe(text)
        norm = self._normal(head)
        m = self.run.match(norm)
        n = m.end() if m else 0
        yield array("i", self.open.feed(self._symbols(norm[:n]))).tobytes()
        if n < len(norm) or last:
            yield array("i", self.open.finish()).tobytes()
            self.open = None
            return norm[n:] + tail
        self.rest = tail
        return ""

    def _symbols(self, word: str) -> str:
        return "".join(map(self.vocab.symbols.__getitem__, word.encode("utf-8")))

    def _word(self, word: str) -> list[int]:
        w = Word(self.vocab)
        return w.feed(self._symbols(word)) + w.finish()


class Decoder:
    """Ids in pieces in, text out."""

    def __init__(self, vocab: Vocabulary, text: bool = False):
        self.vocab, self.text, self.first = vocab, text, True
        self.bytes = codecs.getincrementaldecoder("utf-8")("replace")
        self.space = False

    def feed(self, ids) -> str:
        tokens = [t for t in map(self.vocab.tokens.get, ids) if t is not None]
        if not self.text:
            out = " ".join(tokens)
            out = out if self.first or not tokens else " " + out
            self.first = self.first and not tokens
            return out
        out = []
        end = self.vocab.end
        for t in tokens:
            if self.space:
                out.append(" ")
                self.space = False
            if t in self.vocab.special:
                out.append(self.bytes.decode(b"", True) + t)
                self.bytes.reset()
                continue
            closes = bool(end) and t.endswith(end)
            out.append(self.bytes.decode(bytes(self.vocab.table[c] for c in (t[:-len(end)] if closes else t)), closes))
            self.space = closes
        return "".join(out)

    def finish(self) -> str:
        self.space = False
        return self.bytes.decode(b"", True) if self.text else ""


_CACHES: dict[str, tuple[dict[str, bytes], dict[str, list[int]]]] = {}


def encode_text(text: str, path: str) -> np.ndarray:
    t = Transducer(vocabulary(path), _CACHES.setdefault(path, ({}, {})))
    out: list[bytes] = []
    for at in range(0, len(text), PIECE):
        out += t.feed(text[at:at + PIECE], at + PIECE >= len(text))
    return np.frombuffer(b"".join(out), np.int32)


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` array<int>."""
    docs = docs.drop("ids")
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                got = [encode_text(x.as_py() or "", path) for x in batch.column(text)]
                ends = np.concatenate([[0], np.cumsum([len(x) for x in got])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(got) if got else np.empty(0, np.int32)))
                yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=[*names, "ids"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def decode(docs: DataFrame, path: str, text: bool = False) -> DataFrame:
    """``docs`` (with ``ids``) with ``decoded``."""
    docs = docs.drop("decoded")
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                values, offsets = list_column(batch, "ids")
                out = []
                for a, b in zip(offsets[:-1], offsets[1:]):
                    d = Decoder(vocab, text)
                    out.append("".join([d.feed(values[i:min(i + PIECE, b)].tolist()) for i in range(a, b, PIECE)]) + d.finish())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*names, "decoded"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("decoded", T.StringType())]))
