"""Byte-level BPE by per-prefix dynamic programming: exact ids without replaying merges.

The encoding of a text has a unique last token for each of its prefixes. All tokens that end at a place are found
by one automaton over the vocabulary; the last token of a prefix is the one of them that can follow the last token
of the prefix before it, which is a test on the two tokens alone. The ids are read off by walking back.

Null and empty texts give no ids. A text is encoded whole, whatever its length; a special token's own text gives
its id. Rows that repeat are encoded again; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import json
import struct

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame

from visitry.llm.text import map_lists

PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?{L}+| ?{N}+| ?[^\s{LN}]+|\s+(?!\S)|\s+"
# Letters and numbers that came after the Unicode version (16) of the tokenizers library.
LATER = [
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2),
    (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7),
    (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1),
    (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3),
    (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2),
    (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6),
    (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE),
    (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF),
    (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
]
#: Pieces whose ids, and pairs whose test, are remembered per Python worker; beyond that, remembering starts anew.
REMEMBERED = 200_000


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files: itself, or the next one from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabulary(path: str) -> dict:
    """Tokens, merges and special tokens of a byte-level BPE file, as plain lists for a broadcast."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    letters = byte_letters()
    ids = model["model"]["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
    return {
        "tokens": {i: bytes(letters[c] for c in t) for t, i in ids.items()},
        "merges": [(ids[a], ids[b], ids[a + b]) for a, b in merges],
        "special": {t["content"]: t["id"] for t in model["added_tokens"]},
    }


class Encoder:
    """Encodes texts; holds the automaton and what was found for pieces seen before."""

    def __init__(self, vocabulary: dict):
        self.bytes = dict(vocabulary["tokens"])
        self.pair, self.rank, self.parts = {}, {}, {}
        for rank, (a, b, ab) in enumerate(vocabulary["merges"]):
            self.pair[a, b] = rank
            self.rank[ab], self.parts[ab] = rank, (a, b)
        self.fits: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self.whole, self.automaton = {}, ahocorasick.Automaton()
        for i, t in self.bytes.items():
            if i not in self.parts or self.follows(*self.parts[i], self.rank[i]):
                self.whole[t] = i
                self.automaton.add_word(t.decode("latin-1"), (len(t), i))
        self.automaton.make_automaton()
        later = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in LATER)
        self.later = regex.compile(f"[{later}]")
        self.pieces = regex.compile(PIECES.replace("{LN}", r"\p{L}\p{N}").replace("{L}", r"\p{L}").replace("{N}", r"\p{N}"))
        old = {c: f"[\\p{{{c}}}--[{later}]]" for c in "LN"}
        self.pieces_later = regex.compile(
            PIECES.replace(r"[^\s{LN}]", rf"[^\s[{old['L']}{old['N']}]]").replace("{L}", old["L"]).replace("{N}", old["N"]), regex.V1
        )
        special = vocabulary["special"]
        self.special = special
        self.cut = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.bytes |= {i: t.encode() for t, i in special.items()}

    def follows(self, a: int, b: int, bound: float = float("inf")) -> bool:
        """Whether no merge of rank under `bound` joins a and b, or what they were made of, across the cut.

        Goes back in time: the later of the two merges next to the cut is undone first. Of two equal merges the
        left one was made first.
        """
        while True:
            if self.pair.get((a, b), bound) < bound:
                return False
            ra, rb = self.rank.get(a, -1), self.rank.get(b, -1)
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                bound, a = min(bound, ra), self.parts[a][1]
            else:
                bound, b = min(bound, rb + 1), self.parts[b][0]

    def piece(self, data: bytes) -> list[int]:
        """Ids of one piece: the last token of every prefix, then the way back."""
        if data in self.whole:
            return [self.whole[data]]
        last: list[int | None] = [None] * (len(data) + 1)
        back = [0] * (len(data) + 1)
        fits, follows = self.fits, self.follows
        if len(fits) > REMEMBERED:
            fits.clear()
        for end, (size, token) in self.automaton.iter(data.decode("latin-1")):
            end += 1
            if last[end] is not None:
                continue
            start = end - size
            if start:
                before = last[start]
                if before is None:
                    continue
                pair = before << 32 | token
                ok = fits.get(pair)
                if ok is None:
                    ok = fits[pair] = follows(before, token)
                if not ok:
                    continue
            last[end], back[end] = token, start
        ids, at = [], len(data)
        while at:
            ids.append(last[at])
            at = back[at]
        return ids[::-1]

    def plain(self, text: str) -> bytes:
        known, out = self.known, []
        pieces = self.pieces if text.isascii() or not self.later.search(text) else self.pieces_later
        for piece in pieces.findall(text):
            ids = known.get(piece)
            if ids is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                found = self.piece(piece.encode())
                ids = struct.pack(f"<{len(found)}I", *found)
                if len(piece) <= 64:
                    known[piece] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.cut is None or not any(s in text for s in self.special):
            return self.plain(text)
        parts = self.cut.split(text)
        return b"".join(struct.pack("<I", self.special[p]) if k % 2 else self.plain(p) for k, p in enumerate(parts))

    def decode(self, ids: memoryview) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


#: The encoder of this Python worker, by vocabulary.
_ENCODERS: dict[str, Encoder] = {}


def _maker(df: DataFrame, vocabulary: str, kind):
    shared = df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def make():
        encoder = _ENCODERS.get(vocabulary)
        if encoder is None:
            _ENCODERS.clear()
            encoder = _ENCODERS[vocabulary] = Encoder(shared.value)
        return kind(encoder)

    return make


def bpe_encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, ids of the whole text. vocabulary: path of a byte-level BPE file; it is read on the driver."""

    def kind(encoder):
        return lambda doc, text: (doc, [np.frombuffer(encoder.encode(t), dtype="<i4") for t in text])

    return map_lists(docs, ["doc_id", "text"], "doc_id long, ids array<int>", _maker(docs, vocabulary, kind))


def bpe_decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, text of ids. Bytes that are no UTF-8 become the replacement character; null ids give an empty text."""

    def kind(encoder):
        return lambda doc, ids: (doc, [encoder.decode(i or []) for i in ids])

    return map_lists(encoded, ["doc_id", "ids"], "doc_id long, text string", _maker(encoded, vocabulary, kind))


def bpe_digest(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded text: encode, then decode what was encoded, in one pass."""

    def one(encoder, text):
        ids = encoder.encode(text)
        decoded = encoder.decode(memoryview(ids).cast("I"))
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()

    def kind(encoder):
        return lambda doc, text: (doc, *map(list, zip(*(one(encoder, t) for t in text)))) if doc else ([], [], [], [])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_lists(docs, ["doc_id", "text"], schema, _maker(docs, vocabulary, kind))
