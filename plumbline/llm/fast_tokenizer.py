"""Ids of the tokenizers library at corpus speed.

A text is cut at spaces and line ends, where this kind of vocabulary (white space
dropped, words cut before merging) never merges, and each distinct chunk is encoded
once by the library; a worker keeps the ids of chunks it has met.  ``exact_chunks``
tests the vocabulary for that property; any other tokenizer encodes whole texts.
"""

from __future__ import annotations

import json
from array import array

import numpy as np
import regex

#: Chunks that a worker keeps; the store starts anew when full, so memory is bounded.
CACHE_ENTRIES = 300_000

#: Composed characters for which lower-casing one by one equals lower-casing the word.
_PLAIN = regex.compile(r"[\x21-\x7e¡-¬®-įı-ɏ‐-‧‰-⁞₠-₿]*")
_ENGINES: dict[int, "Engine"] = {}


def load_json(path: str | None = None) -> str:
    """The tokenizer's file as text; the driver reads it once and ships it to the tasks."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


def vocabulary_size(text: str) -> int:
    spec = json.loads(text)
    return 1 + max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])


def engine(text: str) -> "Engine":
    key = hash(text)
    if key not in _ENGINES:
        _ENGINES[key] = Engine(text)
    return _ENGINES[key]


class _Chunks(dict):
    """Ids of a chunk as packed 32-bit little-endian bytes.

    Capitalised words and words with a mark behind them come from the plain word's
    entry, so that the store holds each word once.
    """

    def __init__(self, owner: "Engine"):
        super().__init__()
        self.owner = owner

    def __missing__(self, chunk: str) -> bytes:
        owner = self.owner
        if owner.split is not None:
            core, tail = (chunk[:-1], self.get(chunk[-1])) if chunk[-1:] in _MARKS else (chunk, b"")
            if tail is not None and core.isalpha() and (core.isascii() or _PLAIN.fullmatch(core)):
                low = core.lower()
                got = self.get(low)
                return (self.keep(low, owner.word(low)) if got is None else got) + tail
        return self.keep(chunk, owner.chunk(chunk))

    def keep(self, chunk: str, got: bytes) -> bytes:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        self[chunk] = got
        return got


_MARKS = frozenset(".,;:!?")


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Engine:
    def __init__(self, text: str):
        from tokenizers import Tokenizer

        spec = json.loads(text)
        self.tokenizer = Tokenizer.from_str(text)
        self.split, self.chunked = exact_chunks(spec)
        self.added = regex.compile("|".join(regex.escape(t["content"]) for t in spec["added_tokens"]) or r"(?!)")
        self.model = self.tokenizer.model
        self.bytes_to_chars = {b: c for c, b in _byte_alphabet().items()}
        self.chunks = _Chunks(self)

    def word(self, word: str) -> bytes:
        """A normalised lower-case word, or any other single match of the word pattern."""
        shown = word if word.isascii() else word.encode().decode("latin-1").translate(self.bytes_to_chars)
        got = self.model.tokenize(shown)
        return array("I", [t.id for t in got]).tobytes() if len(got) > 1 else got[0].id.to_bytes(4, "little") if got else b""

    def chunk(self, chunk: str) -> bytes:
        if self.split is not None and _PLAIN.fullmatch(chunk) and not self.added.search(chunk):
            return b"".join([self.word(w) for w in self.split.findall(chunk.lower())])
        return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if not self.chunked:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return b"".join(map(self.chunks.__getitem__, text.replace("\n", " ").split(" ")))


def exact_chunks(spec: dict) -> tuple[regex.Pattern | None, bool]:
    """(word pattern, True) if the vocabulary drops white space and ends words with a suffix.

    Then no id spans a space, the normaliser maps characters one by one, and added
    tokens hold no space.
    """
    norm = spec.get("normalizer") or {}
    parts = [n["type"] for n in norm.get("normalizers", [])]
    pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    fits = (
        parts == ["NFC", "Replace", "Lowercase"]
        and norm["normalizers"][1]["pattern"] == {"Regex": r"\s+"}
        and [p["type"] for p in pre] == ["Split", "ByteLevel"]
        and pre[0]["behavior"] == "Removed"
        and pre[0]["invert"]
        and not pre[1]["use_regex"]
        and not pre[1]["add_prefix_space"]
        and not spec.get("post_processor")
        and not any(t["lstrip"] or t["rstrip"] or t["normalized"] or t["single_word"] or " " in t["content"] for t in spec["added_tokens"])
    )
    return (regex.compile(pre[0]["pattern"]["Regex"]), True) if fits else (None, False)
