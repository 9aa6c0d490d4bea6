"""Token ids of whole texts by a vocabulary file, with a cache of words.

BPE works on each pre-token by itself and both supported kinds of pre-tokenizer never join
characters over a single inner space, so a text can be encoded chunk by chunk. Chunks repeat,
and the cache keeps the ids of each as little-endian unsigned 32-bit integers. Where a vocabulary
lowers case, texts of ASCII and Western letters are cut into its pre-tokens at once: these repeat more
than words do with their capitals and punctuation, so a worker meets fewer new ones.
"""

from __future__ import annotations

import json
import re
import struct

import numpy as np

from .common import WORD, worker_state

#: The cache is emptied when it holds this many chunks.
CACHE_CHUNKS = 500_000
_LETTERS = "À-ÖØ-öø-ÿŒœ"


def _shown_bytes() -> list[str]:
    """Byte-level BPE shows printable bytes as themselves and the others from code point 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    shown, other = [], 256
    for byte in range(256):
        shown.append(chr(byte if byte in printable else other))
        other += byte not in printable
    return shown


_SHOWN = _shown_bytes()


_WESTERN = re.compile(rf"[\t\n\r -~{_LETTERS}]*").fullmatch
#: The byte-level pattern that the library builds in.
BYTE_LEVEL_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def _fast_bpe(kinds: dict):
    """A quicker implementation of the same byte-level BPE, with the ranks of the same file.

    In such a vocabulary the ids rise in the order of the merges. It serves texts of printable
    ASCII and Western letters, on whose classes the two pattern engines agree.
    """
    import tiktoken

    special = {t["content"] for t in kinds.get("added_tokens", [])}
    byte = {c: i for i, c in enumerate(_SHOWN)}
    ranks = {
        bytes(map(byte.__getitem__, token)): i
        for token, i in kinds["model"]["vocab"].items()
        if token not in special
    }
    return tiktoken.Encoding(
        "own", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={}
    ).encode_ordinary


class Encoder:
    """encode(text) gives the ids that the tokenizers library gives without special tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            content = file.read()
        self.whole = Tokenizer.from_str(content)
        kinds = json.loads(content)
        # a text with added tokens of the file goes to the library whole, as it is by default
        added = kinds.get("added_tokens") or []
        self._added = re.compile("|".join(re.escape(t["content"]) for t in added), re.IGNORECASE).search if added else None
        self._normal = any(t.get("normalized") for t in added) and self.whole.normalizer or None
        pre = kinds.get("pre_tokenizer") or {}
        self.byte_level = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
        drops_space = pre.get("type") == "Sequence" and any(
            p.get("type") == "Split" and p.get("behavior") == "Removed"
            for p in pre["pretokenizers"]
        )
        if not self.byte_level and not drops_space:
            raise ValueError(f"unknown kind of pre-tokenizer in {path}")
        self.lower = not self.byte_level
        self._fast = _fast_bpe(kinds) if self.byte_level else None
        #: the size of the vocabulary
        self.size = self.whole.get_vocab_size()
        self.cache = _Chunks(self)
        space = "" if self.lower else " ?"
        digits = "[0-9]" if self.lower else "[0-9]+"
        self._simple = re.compile(f" ?[!-~{_LETTERS}]+").fullmatch
        self._bpe = self.whole.model.tokenize
        self._pieces = re.compile(
            f"'s|'t|'re|'ve|'m|'ll|'d|{space}[A-Za-z{_LETTERS}]+|{space}{digits}|{space}[^ A-Za-z0-9{_LETTERS}]+"
        ).findall
        # the pre-tokens of a lower-case Western text; the kinds begin with different characters
        self._lowered = re.compile(
            rf"[a-z{_LETTERS}]+|[0-9]|'(?:[stmd]|re|ve|ll)|[^\sa-z0-9{_LETTERS}]+"
        ).findall
        self._split = re.compile(r"(?<=\S) (?=\S)").split
        self._words = re.compile(WORD).findall

    def encode(self, text: str | None) -> bytes:
        """Ids of the text as little-endian unsigned 32-bit integers; null counts as empty."""
        if not text:
            return b""
        if self._added and (self._added(text) or self._normal and self._added(self._normal.normalize_str(text))):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if self._fast and _WESTERN(text):
            return np.array(self._fast(text), "<u4").tobytes()
        if len(self.cache) > CACHE_CHUNKS:
            self.cache.clear()
        if self.lower:
            chunks = self._lowered(text.lower()) if _WESTERN(text) else self._words(text)
        else:
            first, *rest = self._split(text)
            chunks = [first]
            chunks += [" " + x for x in rest]
        return b"".join(map(self.cache.__getitem__, chunks))

    def chunk(self, chunk: str) -> bytes:
        """Ids of one chunk: the library's normalizer, pre-tokenizer and BPE in turn.

        Printable ASCII and Western letters, where Python's rules are known to give the same
        pre-tokens, skip the library's slower first two steps.
        """
        if self._simple(chunk):
            text = chunk.lower() if self.lower else chunk
            pieces = [text] if text.isalpha() else self._pieces(text)
            if len(pieces) > 1:
                return b"".join(map(self.cache.__getitem__, pieces))
            pieces = [
                p.replace(" ", _SHOWN[32]) if p.isascii() else "".join(map(_SHOWN.__getitem__, p.encode()))
                for p in pieces
            ]
        else:
            whole = self.whole
            normal = whole.normalizer.normalize_str(chunk) if whole.normalizer else chunk
            pieces = [p for p, _ in whole.pre_tokenizer.pre_tokenize_str(normal)]
        ids = [t.id for p in pieces for t in self._bpe(p)]
        return struct.pack(f"<{len(ids)}I", *ids)


class _Chunks(dict):
    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, chunk: str) -> bytes:
        self[chunk] = out = self.encoder.chunk(chunk)
        return out


def encoder(path: str) -> Encoder:
    """The worker's encoder for this file, loaded once."""
    state = worker_state()
    if ("encoder", path) not in state:
        state["encoder", path] = Encoder(path)
    return state["encoder", path]
