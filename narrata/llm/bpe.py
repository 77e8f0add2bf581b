"""Token ids of many texts: each distinct pre-token is encoded once per worker.

The byte-level BPE vocabulary encodes the pieces of its public splitting
pattern one by one, so a text's ids are the ids of its pieces in order. Pieces
are found by numpy over code points, looked up by hash, and those not seen yet
go to the tokenizers library. Texts with a special token or with characters
outside the table below go to the library whole. Results equal
``Tokenizer.encode(text, add_special_tokens=False).ids`` for every text.
"""

from __future__ import annotations

import hashlib
import unicodedata

import numpy as np

from narrata.llm.words import span_hashes

DEFAULT_VOCABULARY = "byte_bpe_50k.json"
#: Distinct pieces kept per worker before the table starts anew (about 50 MB).
MAX_PIECES = 1_500_000
_SPACE, _LETTER, _NUMBER, _OTHER, _UNKNOWN = 0, 1, 2, 3, 255
_TABLE_END = 0x2028


_SEPARATOR = b"\xff"  # never part of UTF-8


def _byte_alphabet() -> dict[int, str]:
    """The public byte-level alphabet: printable bytes stand for themselves, the rest follow from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    table = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return table | {_SEPARATOR[0]: " "}


_BYTE_ALPHABET = _byte_alphabet()


def _class_table() -> np.ndarray:
    table = np.full(_TABLE_END + 1, _UNKNOWN, np.uint8)
    for cp in [*range(0x250), *range(0x2010, 0x2028)]:
        kind = unicodedata.category(chr(cp))[0]
        table[cp] = {"L": _LETTER, "N": _NUMBER}.get(kind, _OTHER)
    for cp in (*range(0x09, 0x0E), 0x20, 0x85, 0xA0):
        table[cp] = _SPACE
    return table


def vocabulary_path(name: str = DEFAULT_VOCABULARY) -> str:
    """Where the public vocabulary file lies on this machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


class PieceEncoder:
    """Encodes lists of texts; one per worker and vocabulary, see :func:`encoder`."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tok = Tokenizer.from_file(path)
        # the same model over pieces that are already in its byte alphabet, with blanks between them
        self.model = Tokenizer(self.tok.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.dtype = np.uint16 if self.tok.get_vocab_size() <= 1 << 16 else np.uint32
        self.classes = _class_table()
        self._reset()

    def _reset(self) -> None:
        self.keys, self.entry = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.flat, self.used = np.zeros(1 << 16, self.dtype), 0
        self.start, self.length = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int32)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, self.dtype)

    def pieces(self, cps: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where the pieces of texts begin that lie one after another in ``cps``."""
        n = len(cps)
        cl = self.classes[cps]
        space, blank = cl == _SPACE, cps == 0x20
        doc = np.zeros(n + 1, bool)
        doc[offsets] = True
        begin = np.ones(n, bool)
        begin[1:] = (cl[1:] != cl[:-1]) & ~(blank[:-1] & ~space[1:])
        # the last of several white-space characters stands alone, or before the word if it is a blank
        if n > 2:
            begin[1:-1] |= space[1:-1] & space[:-2] & ~space[2:] & ~doc[2:n]
        begin[offsets[offsets < n]] = True
        quote = np.flatnonzero(cps == 0x27)
        if len(quote):
            prev = np.maximum(quote - 1, 0)
            opens = doc[quote] | (cl[prev] == _LETTER) | (cl[prev] == _NUMBER) | (space[prev] & ~blank[prev])
            one = np.append(cps, [0, 0])
            edge = np.append(doc, True)
            a = np.where(edge[quote + 1], 0, one[quote + 1])
            b = np.where(edge[quote + 1] | edge[quote + 2], 0, one[quote + 2])
            short = opens & np.isin(a, [ord(c) for c in "stmd"])
            long = opens & (((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e")))
                            | ((a == ord("l")) & (b == ord("l"))))
            begin[quote[short | long] + 1] = False
            for hit, size in ((short, 2), (long, 3)):
                rest = quote[hit] + size
                begin[rest[rest < n]] = True
        return np.flatnonzero(begin)

    def _learn(self, pieces: list[str]) -> None:
        """Encode pieces that are new, many at a time, and append their ids to the table."""
        at = len(self.keys)
        while at + len(pieces) > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.length = np.concatenate([self.length, np.zeros_like(self.length)])
        for lo in range(0, len(pieces), 4000):
            part = pieces[lo:lo + 4000]
            line = _SEPARATOR.join([p.encode("utf-8", "surrogatepass") for p in part])
            found = self.model.encode(line.decode("latin-1").translate(_BYTE_ALPHABET), add_special_tokens=False)
            ids = np.array(found.ids, self.dtype)
            sizes = np.bincount(np.array(found.word_ids, np.int64), minlength=len(part))
            while self.used + len(ids) > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
            self.flat[self.used:self.used + len(ids)] = ids
            own = slice(at + lo, at + lo + len(part))
            self.start[own], self.length[own] = self.used + np.cumsum(sizes) - sizes, sizes
            self.used += len(ids)

    def piece_numbers(self, joined: str, cps: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """The table's entry of each piece; pieces that are new are encoded first."""
        end = np.append(begin[1:], len(cps))
        hashes = span_hashes(cps, begin, end)
        for i in np.flatnonzero(end - begin > 64):  # too long to trust a polynomial hash
            raw = joined[begin[i]:end[i]].encode("utf-8", "surrogatepass")
            hashes[i] = int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little")
        unique, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) + len(unique) > MAX_PIECES:
            self._reset()
        at = np.searchsorted(self.keys, unique)
        new = np.ones(len(unique), bool)
        if len(self.keys):
            new = self.keys[np.minimum(at, len(self.keys) - 1)] != unique
        if new.any():
            b, e = begin[first[new]].tolist(), end[first[new]].tolist()
            self._learn([joined[x:y] for x, y in zip(b, e, strict=True)])
            n = len(self.keys)
            self.entry = np.insert(self.entry, at[new], np.arange(n, n + len(b), dtype=np.int32))
            self.keys = np.insert(self.keys, at[new], unique[new])
            at = np.searchsorted(self.keys, unique)
        return self.entry[at][inverse]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and each text's number of ids."""
        texts = [t or "" for t in texts]
        alone = {i for i, t in enumerate(texts) if any(s in t for s in self.special)}
        lengths = np.array([0 if i in alone else len(t) for i, t in enumerate(texts)], np.int64)
        joined = "".join(t for i, t in enumerate(texts) if i not in alone)
        cps = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        unknown = np.flatnonzero(self.classes[np.minimum(cps, _TABLE_END)] == _UNKNOWN)
        if len(unknown):
            rows = np.searchsorted(np.cumsum(lengths), unknown, "right")
            alone |= set(np.unique(rows).tolist())
            lengths[list(alone)] = 0
            joined = "".join(t for i, t in enumerate(texts) if i not in alone)
            cps = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        counts = np.zeros(len(texts), np.int64)
        ids = np.zeros(0, self.dtype)
        if len(cps):
            begin = self.pieces(cps, offsets)
            number = self.piece_numbers(joined, cps, begin)
            size = self.length[number]
            before = np.cumsum(size) - size
            ids = self.flat[np.repeat(self.start[number] - before, size) + np.arange(int(size.sum()))]
            upto = np.append(before, len(ids))[np.searchsorted(begin, offsets, "left")]
            counts = np.diff(upto)
        if alone:
            parts, at = [], 0
            for i, t in enumerate(texts):
                own = self.whole(t) if i in alone else ids[at:at + counts[i]]
                at += 0 if i in alone else counts[i]
                counts[i] = len(own)
                parts.append(own)
            ids = np.concatenate(parts)
        return ids, counts


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str | None = None) -> PieceEncoder:
    """This worker's encoder for a vocabulary file (the default public one if not named)."""
    path = path or vocabulary_path()
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]
