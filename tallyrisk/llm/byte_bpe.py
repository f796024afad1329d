"""Byte-level BPE ids of any text, under a public vocabulary file whose path is a parameter.

The encoder's splitting pattern backs up over runs of white space and gives out on very long ones.  Such runs are therefore cut off
before it, at the place where the pattern itself cuts: a run of n blanks in front of other text is one stretch of n - 1 blanks,
and the last blank belongs to what follows; a run at the end of the text is one stretch.
"""
from __future__ import annotations

import base64
import json
import os
import re
from functools import lru_cache

#: runs from this length on are cut off before the encoder
LONG_RUN = 4096
#: the White_Space property, which the pattern's \s stands for
_BLANK = "\t-\r \x85\xa0  -     　"
_RUN = re.compile(rf"[{_BLANK}]{{{LONG_RUN},}}")


def byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in a byte-level vocabulary: visible Latin-1 characters for themselves, the other
    bytes in order from code point 256 on."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabulary(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """(bytes -> id, special string -> id) of a ``.json`` tokenizer file or a ``.tiktoken`` rank file.

    A rank file names no specials: they are those of the tokenizer file of the same name beside it, if there is one."""
    if path.endswith(".json"):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        byte = byte_alphabet()
        return {bytes(map(byte.__getitem__, w)): i for w, i in spec["model"]["vocab"].items() if w not in specials}, specials
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    beside = path.removesuffix(".tiktoken") + ".json"
    return ranks, read_vocabulary(beside)[1] if os.path.exists(beside) else {}


class ByteBpe:
    """Ids of whole texts.  With ``specials`` the special strings of the file are single ids wherever they stand, else plain text."""

    def __init__(self, path: str, specials: bool):
        import public_tokenizers
        import tiktoken
        self.vocabulary, found = read_vocabulary(path)
        self.specials = found if specials else {}
        self.enc = tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=self.vocabulary,
                                     special_tokens=self.specials)

    def __call__(self, text: str) -> list[int]:
        if len(text) < LONG_RUN or not _RUN.search(text):
            return self._plain(text)
        # a special string ends the text before it, so stretches are cut there first
        parts = re.split("(" + "|".join(map(re.escape, self.specials)) + ")", text) if self.specials else [text]
        out: list[int] = []
        for part in parts:
            if part in self.specials:
                out.append(self.specials[part])
                continue
            at = 0
            for run in _RUN.finditer(part):
                end = run.end() if run.end() == len(part) else run.end() - 1
                out += self._plain(part[at:run.start()])
                out += self.enc._core_bpe.encode_single_piece(part[run.start():end].encode("utf-8"))
                at = end
            out += self._plain(part[at:])
        return out

    def _plain(self, text: str) -> list[int]:
        if any(s in text for s in self.specials):
            return self.enc.encode(text, allowed_special="all")
        return self.enc.encode_ordinary(text)


@lru_cache(maxsize=4)
def byte_bpe(path: str, specials: bool) -> ByteBpe:
    return ByteBpe(path, specials)
