"""Token ids of whole texts, by a tokenizer of the ``tokenizers`` library.

A tokenizer that lower-cases and drops white space before it splits, by one known rule, has no token
that spans white space, and a text's ids are those of its pieces in order. Pieces repeat; their ids are
kept in a bounded memo. Texts of ASCII and common Latin letters are split here by that rule, which is simple for
them, and their pieces go to the library's BPE model; chunks with any other character go through
the whole library. Whether a file has that rule is read from it; whole texts go through the library if
it has another. Tests hold the ids against the library's on whole texts.
"""

from __future__ import annotations

import json
import re

import numpy as np

#: Entries that a memo holds: some 150 MB for a worker. Words beyond it are encoded each time.
MEMO = 600_000

# The steps of a tokenizer whose split rule is the one below.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": _SPLIT}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]}
# Fixed values of that split rule, for ASCII and the letters of Latin-1.
_PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*")
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\t-\r a-z0-9ß-öø-ÿ]+")
#: Characters at which Python's split() parts words, but the tokenizer doesn't.
_NOT_SPACE = re.compile(r"[\x1c-\x1f]")
_SPACE = re.compile(r"[^\S\x1c-\x1f]+")


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level BPE writes for each byte: itself if visible, else one past U+00FF."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def has_known_rule(tokenizer: dict) -> bool:
    """Whether a tokenizer, as its file spells it, splits by the rule of this module; added tokens then start with ``<|``."""
    steps = tokenizer.get("normalizer") == _NORMALIZER and tokenizer.get("pre_tokenizer") == _PRE_TOKENIZER
    plain = not tokenizer.get("truncation") and not tokenizer.get("padding") and not tokenizer.get("post_processor")
    model = tokenizer["model"]["type"] == "BPE" and not tokenizer["model"].get("dropout")
    return steps and plain and model and all(t["content"].startswith("<|") and not (t["lstrip"] or t["rstrip"]) for t in tokenizer.get("added_tokens", []))


class Encoder:
    """``encode(text)`` gives a text's ids as little-endian unsigned integers of ``width`` bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.width = 2 if self.library.get_vocab_size() <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        self.known_rule = has_known_rule(json.loads(self.library.to_str()))
        if not self.known_rule:  # a file's own cuts and fillings have no place in ids of whole texts
            self.library.no_truncation()
            self.library.no_padding()
        self.letters = _byte_letters()
        self.pieces: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def _pack(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def _piece(self, piece: str) -> bytes:
        spelled = piece if piece.isascii() else "".join(map(self.letters.__getitem__, piece.encode()))
        got = self._pack([t.id for t in self.library.model.tokenize(spelled)])
        if len(self.pieces) < MEMO:
            self.pieces[piece] = got
        return got

    def _chunk(self, chunk: str) -> bytes:
        if _PLAIN.fullmatch(chunk) and "<|" not in chunk:
            return self._plain(chunk)
        got = self.chunks.get(chunk)
        if got is None:
            got = self._pack(self.library.encode(chunk, add_special_tokens=False).ids)
            if len(self.chunks) < MEMO // 4:
                self.chunks[chunk] = got
        return got

    def _plain(self, text: str) -> bytes:
        memo, new = self.pieces.get, self._piece
        return b"".join([memo(piece) or new(piece) for piece in _PIECES.findall(text.lower())])

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.known_rule:
            return self._pack(self.library.encode(text, add_special_tokens=False).ids)
        if "<|" not in text and _PLAIN.fullmatch(text):
            return self._plain(text)
        chunks = _SPACE.split(text) if _NOT_SPACE.search(text) else text.split()
        return b"".join(map(self._chunk, chunks))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder, with its memo, for each worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
