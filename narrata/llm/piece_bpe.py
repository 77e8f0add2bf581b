"""SentencePiece BPE encoding by backtracking, and decoding (operator 13).

A merge encoder joins, over and over, the neighbouring symbols whose joint
piece scores highest (the leftmost of equals). Its result is the one sequence
of pieces that cover the text and of which every two neighbours are
*compatible*: merging the symbols of both alone gives just these two again.
(Before the first merge across a border, both sides have merged as they do
alone; so a border that holds for its two pieces holds in the whole text.)

So a text is encoded from the left: an Aho-Corasick automaton over the pieces
finds the longest piece at each place; a piece that isn't compatible with the
one before gives way to its longest shorter prefix; a place without any piece
left is marked in a bit field as failed, and the piece before it gives way.
Compatibility is checked by merging both sides' recorded steps side by side,
and is remembered.

Two neighbouring bytes that no piece holds are never merged across: texts are
cut there, and each distinct segment is encoded once per worker.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from narrata.llm.batches import map_texts, row_chunks, text_buffer
from narrata.llm.words import span_hashes

DEFAULT_MODEL = "piece_bpe_32k.model"
#: Distinct segments, and compatible or incompatible pairs, kept per worker before a table starts anew.
MAX_SEGMENTS, MAX_PAIRS = 1_000_000, 1_000_000
#: Longer segments are encoded each time and not kept.
LONG_SEGMENT = 64
#: Inside this module a piece is its UTF-8 bytes as Latin-1 characters, with a blank for the mark of a word's begin.
MARK = "▁".encode()
_CHARACTER = re.compile("[\x00-\x7f\xc0-\xff][\x80-\xbf]*")
_NO_SCORE = float("-inf")


def model_path(name: str = DEFAULT_MODEL) -> str:
    """Where the public model file lies on this machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


class PieceModel:
    """Pieces and scores of a model file, and encoding and decoding with them; one per worker."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        kinds = proto.SentencePiece
        spec, trainer = proto.normalizer_spec, proto.trainer_spec
        plain = spec.name == "identity" and not spec.precompiled_charsmap and not spec.remove_extra_whitespaces
        known = {kinds.NORMAL, kinds.UNKNOWN, kinds.CONTROL, kinds.BYTE}
        if trainer.model_type != trainer.BPE or not plain or not spec.escape_whitespaces \
                or trainer.treat_whitespace_as_suffix or any(p.type not in known for p in proto.pieces):
            raise ValueError(f"{path}: not a plain BPE model (identity normaliser, no user-defined or unused pieces)")
        self.prefix = b" " if spec.add_dummy_prefix else b""
        self.id_of: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.bytes_of: list[bytes] = []
        self.byte_ids: dict[int, int] = {}
        self.silent: set[int] = set()
        for i, p in enumerate(proto.pieces):
            raw = p.piece.encode().replace(MARK, b" ")
            if p.type == kinds.BYTE:
                raw = bytes([int(p.piece[3:5], 16)])
                self.byte_ids[raw[0]] = i
            elif p.type == kinds.NORMAL:
                self.id_of[raw.decode("latin-1")], self.score[raw.decode("latin-1")] = i, p.score
            elif p.type == kinds.UNKNOWN:
                self.unknown, raw = i, trainer.unk_surface.encode()
            else:
                self.silent.add(i)
                raw = b""
            self.bytes_of.append(raw)
        ids = {p.piece: i for i, p in enumerate(proto.pieces)}
        self.begin, self.end = ids[trainer.bos_piece], ids[trainer.eos_piece]
        self.size = len(proto.pieces)
        if trainer.byte_fallback and len(self.byte_ids) < 256:
            raise ValueError(f"{path}: byte fallback without 256 byte pieces")
        self.fallback = trainer.byte_fallback

        self.longest = ahocorasick.Automaton()
        inside = np.zeros((256, 256), bool)
        for piece in self.id_of:
            self.longest.add_word(piece, len(piece))
            raw = np.frombuffer(piece.encode("latin-1"), np.uint8)
            inside[raw[:-1], raw[1:]] = True
        self.longest.make_automaton()
        #: Two bytes between which a text may be cut: no piece holds them, and the second begins a character.
        self.cut = (~inside & ((np.arange(256) & 0xC0) != 0x80)[None, :]).ravel()
        self._traces: dict[str, tuple] = {}
        self._shorter: dict[str, int] = {}
        self._pairs: dict[tuple[str, str], bool] = {}
        self._reset()

    # --- merging ---------------------------------------------------------------

    def _trace(self, piece: str) -> tuple:
        """Merging a piece alone: whether one symbol is left, the scores of its steps, its left and right symbols before
        each step and at the end."""
        found = self._traces.get(piece)
        if found is None:
            symbols = _CHARACTER.findall(piece)
            scores, lefts, rights = [], [symbols[0]], [symbols[-1]]
            while len(symbols) > 1:
                options = [self.score.get(a + b, _NO_SCORE) for a, b in zip(symbols, symbols[1:], strict=False)]
                best = max(options)
                if best == _NO_SCORE:
                    break
                at = options.index(best)
                symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
                scores.append(best)
                lefts.append(symbols[0])
                rights.append(symbols[-1])
            found = self._traces[piece] = (len(symbols) == 1, [*scores, _NO_SCORE], lefts, rights)
            if len(self._traces) > MAX_PAIRS:  # characters that no piece has are traced too
                self._traces = {}
        return found

    def compatible(self, a: str, b: str) -> bool:
        """Whether merging the symbols of ``a`` and ``b`` together gives ``a`` and ``b``."""
        found = self._pairs.get((a, b))
        if found is None:
            whole_a, scores_a, _, rights = self._trace(a)
            whole_b, scores_b, lefts, _ = self._trace(b)
            found, i, j = whole_a and whole_b, 0, 0
            while found:
                across = self.score.get(rights[i] + lefts[j], _NO_SCORE)
                x, y = scores_a[i], scores_b[j]
                if across > x and across >= y and across != _NO_SCORE:  # of equal scores the leftmost merges
                    found = False
                elif x == y == _NO_SCORE:
                    break
                elif x >= y:
                    i += 1
                else:
                    j += 1
            if len(self._pairs) >= MAX_PAIRS:
                self._pairs = {}
            self._pairs[a, b] = found
        return found

    def _prefix_of(self, piece: str) -> int:
        """Length of the longest shorter piece that begins ``piece``; 0 if none."""
        found = self._shorter.get(piece)
        if found is None:
            found = next((n for n in range(len(piece) - 1, 0, -1) if piece[:n] in self.id_of), 0)
            first = len(_CHARACTER.match(piece).group())
            if not found and first < len(piece):
                found = first
            self._shorter[piece] = found
        return found

    def _backtrack(self, text: str, at: int, end: int, longest: list[int]) -> list[str]:
        """The pieces of ``text[at:end]``."""
        pieces: list[str] = []
        failed = bytearray((end - at) // 8 + 1)
        start, pos = at, at
        size = longest[pos] or _CHARACTER.match(text, pos).end() - pos
        while True:
            piece, to = text[pos:pos + size], pos + size - start
            fits = not failed[to >> 3] >> (to & 7) & 1 and (
                self.compatible(pieces[-1], piece) if pieces else self._trace(piece)[0])
            if fits:
                pieces.append(piece)
                pos += size
                if pos == end:
                    return pieces
                size = longest[pos] or _CHARACTER.match(text, pos).end() - pos
            else:
                size = self._prefix_of(piece)
                if not size:
                    failed[pos - start >> 3] |= 1 << (pos - start & 7)
                    size = len(pieces[-1])
                    pos -= size
                    pieces.pop()

    def _ids(self, pieces: list[str]) -> list[int]:
        out: list[int] = []
        for p in pieces:
            i = self.id_of.get(p)
            if i is not None:
                out.append(i)
            elif self.fallback:
                out += [self.byte_ids[b] for b in p.encode("latin-1")]
            elif not out or out[-1] != self.unknown:  # unknown characters in a row are one piece
                out.append(self.unknown)
        return out

    def segments(self, segments: list[bytes]) -> list[list[int]]:
        """The ids of each segment."""
        text = b"\xff".join(segments).decode("latin-1")  # a byte that no UTF-8 has
        longest = [0] * (len(text) + 1)
        for last, size in self.longest.iter(text):
            longest[last - size + 1] = size  # matches come by their ends: the last one of a place is its longest
        out, at = [], 0
        for s in segments:
            out.append(self._ids(self._backtrack(text, at, at + len(s), longest)))
            at += len(s) + 1
        return out

    # --- many texts --------------------------------------------------------------

    def _reset(self) -> None:
        self.keys, self.entry = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.flat, self.begins = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _numbers(self, raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The table's entry of each short segment; new ones are encoded first."""
        hashes, first, inverse = np.unique(span_hashes(raw, begin, end), return_index=True, return_inverse=True)
        if len(self.keys) + len(hashes) > MAX_SEGMENTS:
            self._reset()
        at = np.searchsorted(self.keys, hashes)
        new = np.ones(len(hashes), bool)
        if len(self.keys):
            new = self.keys[np.minimum(at, len(self.keys) - 1)] != hashes
        if new.any():
            whole = raw.tobytes()
            b, e = begin[first[new]].tolist(), end[first[new]].tolist()
            ids = self.segments([whole[x:y] for x, y in zip(b, e, strict=True)])
            n = len(self.begins) - 1
            self.flat = np.concatenate([self.flat, *(np.array(x, np.uint32) for x in ids)])
            self.begins = np.concatenate([self.begins, self.begins[-1] + np.cumsum([len(x) for x in ids])])
            self.entry = np.insert(self.entry, at[new], np.arange(n, n + len(ids)))
            self.keys = np.insert(self.keys, at[new], hashes[new])
            at = np.searchsorted(self.keys, hashes)
        return self.entry[at][inverse]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Each text's ids, between the begin and the end id; a null text is empty."""
        raw, offsets = text_buffer(texts)
        whole, at = raw.tobytes(), offsets.tolist()
        own = [whole[a:b] for a, b in zip(at, at[1:], strict=False)]
        own = [(self.prefix + t if t else t).replace(MARK, b" ") for t in own]
        raw = np.frombuffer(b"".join(own), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in own])]).astype(np.int64)
        opens = np.zeros(len(raw) + 1, bool)
        opens[1:-1] = self.cut[raw[:-1].astype(np.intp) << 8 | raw[1:]]
        opens[offsets] = True
        edges = np.flatnonzero(opens)
        begin, end = edges[:-1], edges[1:]
        short = end - begin <= LONG_SEGMENT
        sizes = np.zeros(len(begin), np.int64)
        number = self._numbers(raw, begin[short], end[short]) if short.any() else np.zeros(0, np.int64)
        sizes[short] = np.diff(self.begins)[number]
        long = np.flatnonzero(~short).tolist()
        joined = raw.tobytes()
        long_ids = {i: self.segments([joined[begin[i]:end[i]]])[0] for i in long}
        for i, ids in long_ids.items():
            sizes[i] = len(ids)
        total = np.concatenate([[0], np.cumsum(sizes)])
        flat = np.empty(int(total[-1]), np.uint32)
        place = np.repeat(total[:-1][short], sizes[short])
        step = np.arange(int(sizes[short].sum())) - np.repeat(np.cumsum(sizes[short]) - sizes[short], sizes[short])
        flat[place + step] = self.flat[np.repeat(self.begins[number], sizes[short]) + step]
        for i, ids in long_ids.items():
            flat[total[i]:total[i + 1]] = ids
        row = total[np.searchsorted(begin, offsets, "left")].tolist()
        a, z = np.array([self.begin], np.uint32), np.array([self.end], np.uint32)
        return [np.concatenate([a, flat[x:y], z]) for x, y in zip(row, row[1:], strict=False)]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: control ids are silent, the blank before the first word goes, and bytes that aren't UTF-8
        become U+FFFD one by one."""
        bad = int(ids.max()) if len(ids) else 0
        if bad >= self.size:
            raise ValueError(f"piece id {bad} is out of range")
        ids = ids.astype(np.int64)
        spoken = ~np.isin(ids, list(self.silent))
        first = np.flatnonzero(spoken)[:1]
        parts = np.split(ids, np.flatnonzero(~spoken))  # a control id also ends a run of byte pieces
        text = "".join(_text(b"".join([self.bytes_of[i] for i in part.tolist()])) for part in parts)
        blank = len(first) and self.prefix and int(ids[first[0]]) not in (self.unknown, self.byte_ids.get(0x20))
        return text.removeprefix(" ") if blank else text


def _text(raw: bytes) -> str:
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return "".join(_valid_characters(raw))


def _valid_characters(raw: bytes) -> Iterator[str]:
    while raw:
        try:
            yield raw.decode()
            return
        except UnicodeDecodeError as e:
            yield raw[:e.start].decode() + "�"
            raw = raw[e.start + 1:]


_models: dict[str, PieceModel] = {}


def model(path: str | None = None) -> PieceModel:
    """This worker's model of a file (the default public one if not named)."""
    path = path or model_path()
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def _with_column(df: DataFrame, name: str, kind, task) -> DataFrame:
    if name in df.columns:
        raise ValueError(f"the table has a column {name!r} already")
    return map_texts(df, task, StructType([*df.schema.fields, StructField(name, kind, True)]))


def encode(docs: DataFrame, path: str | None = None, text: str = "text", ids: str = "ids") -> DataFrame:
    """All rows and columns, and ``ids``: the text's piece ids with begin and end id, as packed little-endian unsigned
    32-bit integers.

    Equal to the sentencepiece library's ``encode(text, add_bos=True, add_eos=True)``. A null text is empty: begin and
    end id alone. Rows stay rows, also repeated ones; an empty table gives an empty table; a column that is named
    ``ids`` already is an error. One pass, no shuffle; a text of any length is encoded whole.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for rows in row_chunks(batches, text):
            packed = [x.astype("<u4").tobytes() for x in m.encode(rows.column(text))]
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(packed, pa.binary())],
                                             names=[*rows.schema.names, ids])
    return _with_column(docs, ids, BinaryType(), run)


def decode(rows: DataFrame, path: str | None = None, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """All rows and columns, and ``text``: the text of the packed ``ids``, as the library's ``decode(ids)`` gives it.

    Null ids give a null text; an id that the model doesn't have raises ValueError.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            found = [None if x is None else m.decode(np.frombuffer(x, "<u4")) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())],
                                             names=[*batch.schema.names, text])
    return _with_column(rows, text, StringType(), run)


def op13_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of the ids of every document, and the digest of the text decoded from them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    read_back = decode(encode(docs).select("doc_id", "ids"))
    return read_back.select("doc_id", F.expr("CAST(octet_length(ids) DIV 4 AS BIGINT)").alias("n_tokens"),
                            F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
