"""Offset-preserving SentencePiece encoding.

A text is normalised by the model's compiled character map: at every place the longest key of its double-array trie is
replaced, white space becomes the visible mark, and for every byte of the result the byte of the text it stems from is
kept. The normalised text is cut at white space into chunks that no merge crosses, chunks are segmented by the library
with its own normalisation switched off, equal ones of neighbouring texts once, and every piece is projected back through
the kept places to a span of bytes of the original text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The visible mark of white space, and numbers of fields and piece types of a model file.
MARK = "▁"
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_PIECE, _TYPE = 1, 3
_MAP, _DUMMY_PREFIX, _REMOVE_EXTRA, _ESCAPE = 2, 3, 4, 5
_MODEL_TYPE, _SUFFIX_MARK = 3, 24
_BPE = 2
_NORMAL, _UNKNOWN, _USER_DEFINED, _BYTE = 1, 2, 4, 6
# Characters of the texts that are worked at a time, besides one longer text.
PART = 4_000_000


def _number(raw: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = raw[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def _encoded(value: int) -> bytes:
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    out.append(value)
    return bytes(out)


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes, bytes]]:
    """``(field, value, its bytes in the message)`` of a protocol-buffer message."""
    at = 0
    while at < len(raw):
        start = at
        key, at = _number(raw, at)
        kind = key & 7
        if kind == 0:
            value, at = _number(raw, at)
        else:
            size, at = _number(raw, at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value = raw[at : at + size]
            at += size
        yield key >> 3, value, raw[start:at]


class CharacterMap:
    """Longest-prefix replacement by a compiled map: a double-array trie over UTF-8 bytes, and the replacements."""

    def __init__(self, compiled: bytes) -> None:
        size = int.from_bytes(compiled[:4], "little") if compiled else 0
        self.units = np.frombuffer(compiled[4 : 4 + size], "<u4").tolist()
        self.replacements = compiled[4 + size :]
        first = [c for c in range(1, 256) if self.units and self._child(0, c) is not None]
        self.entry = re.compile(b"[" + b"".join(re.escape(bytes([c])) for c in first) + b"]") if first else None

    def _below(self, node: int) -> int:
        unit = self.units[node]
        return node ^ ((unit >> 10) << ((unit & 0x200) >> 6))

    def _child(self, node: int, byte: int) -> int | None:
        child = self._below(node) ^ byte
        return child if child < len(self.units) and self.units[child] & 0x800000FF == byte else None

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """End and replacement of the longest key that starts at ``at``."""
        node, found, place = 0, None, at
        while place < len(text):
            node = self._child(node, text[place])
            if node is None:
                break
            place += 1
            if self.units[node] & 0x100:
                found = place, self.units[self._below(node)] & 0x7FFFFFFF
        if found is None:
            return None
        end, value = found
        return end, self.replacements[value : self.replacements.index(b"\0", value)]

    def replace(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The text with all keys replaced, and for each of its bytes the start of what it stems from."""
        lengths = np.ones(len(text), np.int64)
        parts, done = [], 0
        for entry in self.entry.finditer(text) if self.entry else ():
            at = entry.start()
            hit = self.longest(text, at) if at >= done else None
            if hit is not None:
                end, replacement = hit
                parts += [text[done:at], replacement]
                lengths[at:end] = 0
                lengths[at] = len(replacement)
                done = end
        source = np.arange(len(text))
        if not parts:
            return text, source
        out = b"".join([*parts, text[done:]])
        # What a key covers begins where the key begins.
        return out, np.repeat(source, lengths)


class Model:
    """A model file: pieces, normalisation, and the library's segmentation of normalised text."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        with open(path, "rb") as file:
            raw = file.read()
        pieces, kept, spec, trainer = [], [], {}, {}
        for field, value, whole in _fields(raw):
            if field == _NORMALIZER:
                spec = {f: v for f, v, _ in _fields(value)}
                continue
            kept.append(whole)
            if field == _PIECES:
                piece = {f: v for f, v, _ in _fields(value)}
                pieces.append((piece[_PIECE].decode(), piece.get(_TYPE, _NORMAL)))
            elif field == _TRAINER:
                trainer = {f: v for f, v, _ in _fields(value)}
        if any(kind == _USER_DEFINED for _, kind in pieces) or trainer.get(_SUFFIX_MARK):
            raise ValueError("models with user-defined pieces or white space as a suffix are not supported")
        self.map = CharacterMap(spec.get(_MAP, b""))
        self.prefix, self.squeeze, self.escape = (bool(spec.get(k, 1)) for k in (_DUMMY_PREFIX, _REMOVE_EXTRA, _ESCAPE))
        plain = b"".join(_encoded(k << 3) + b"\0" for k in (_DUMMY_PREFIX, _REMOVE_EXTRA, _ESCAPE))
        own = b"".join(kept) + _encoded(_NORMALIZER << 3 | 2) + _encoded(len(plain)) + plain
        self.segmenter = SentencePieceProcessor(model_proto=own)
        self.library = SentencePieceProcessor(model_proto=raw)
        # Merges never leave a chunk where no piece has the mark after another character.
        crossing = any(MARK in piece.lstrip(MARK) for piece, kind in pieces if kind == _NORMAL)
        self.cuttable = trainer.get(_MODEL_TYPE) == _BPE and not crossing
        self.bytes_of = np.array([1 if kind == _BYTE else len(piece.encode()) for piece, kind in pieces])
        # Bytes that the character of a first byte has; 0 for the bytes that follow and for other pieces.
        self.run = np.zeros(len(pieces), np.int64)
        spelled = [(k, int(piece[3:5], 16)) for k, (piece, kind) in enumerate(pieces) if kind == _BYTE]
        for k, value in spelled:
            self.run[k] = 1 if value < 0x80 else 0 if value < 0xC0 else 2 if value < 0xE0 else 3 if value < 0xF0 else 4
        self.spells = bool(spelled)

    def normalise(self, text: str) -> tuple[bytes, np.ndarray]:
        """Normalised text, and for each of its bytes, and its end, the byte of the text it stems from."""
        raw = text.encode("utf-8", "replace")
        out, source = self.map.replace(raw)
        end = len(raw)
        symbols = np.frombuffer(out, np.uint8)
        if self.squeeze:
            space = symbols == 32
            keep = ~space
            keep[1:] |= ~space[:-1]
            if len(keep):
                keep[: int(space.argmin()) if not space.all() else len(keep)] = False
            symbols, source = symbols[keep], source[keep]
            out = symbols.tobytes()
        mark = MARK.encode() if self.escape else b" "
        if self.escape:
            source = np.repeat(source, np.where(symbols == 32, len(mark), 1))
            out = out.replace(b" ", mark)
        first = int(source[0]) if self.squeeze and len(out) else 0
        while self.squeeze and out.endswith(mark):
            out = out[: -len(mark)]
            end = int(source[len(out)])
            source = source[: len(out)]
        if not len(out):
            return b"", np.zeros(1, np.int64)
        if self.prefix:
            out, source = mark + out, np.r_[np.full(len(mark), first), source]
        return out, np.r_[source, end]

    def _chunks(self, line: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """First byte of every chunk: the start of a text, and of a run of marks."""
        starts = np.zeros(len(line) + 3, bool)
        starts[bounds[:-1]] = True
        if self.cuttable:
            one, two, three = MARK.encode()
            mark = np.zeros(len(line) + 3, bool)
            mark[3:-2] = (line[:-2] == one) & (line[1:-1] == two) & (line[2:] == three)
            starts[:-3] |= mark[3:] & ~mark[:-3]
        return np.flatnonzero(starts[: len(line)])

    def segment(self, normalised: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of normalised texts, and the place of each text's first one."""
        bounds = np.cumsum([0, *map(len, normalised)])
        raw = b"".join(normalised)
        line = np.frombuffer(raw, np.uint8)
        if not len(line):
            return np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
        starts = self._chunks(line, bounds)
        offsets = pa.array(np.r_[starts, len(line)].astype(np.int32))
        chunks = pa.StringArray.from_buffers(len(starts), offsets.buffers()[1], pa.py_buffer(raw)).dictionary_encode()
        code = chunks.indices.to_numpy()
        # A chunk that a part of the table has many times is segmented once.
        found = self.segmenter.encode(chunks.dictionary.to_numpy(zero_copy_only=False).tolist(), num_threads=1)
        size = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.int64, int(size.sum()))
        count = size[code]
        stop = np.cumsum(count)
        ids = flat[np.repeat((np.cumsum(size) - size)[code] - (stop - count), count) + np.arange(stop[-1])]
        return ids, np.r_[0, stop][np.searchsorted(starts, bounds)]

    def spans(self, ids: np.ndarray, source: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First byte, and byte after the last, of each piece in the original text.

        Of a character spelled in bytes the last byte has the whole span and the others an empty one at its start.
        """
        stop = np.cumsum(self.bytes_of[ids])
        start = stop - self.bytes_of[ids]
        begin, end = source[start], source[stop]
        lead = np.flatnonzero(self.run[ids] > 1)
        if len(lead):
            rest = self.run[ids[lead]] - 1
            inside = np.repeat(lead, rest) + np.arange(rest.sum()) - np.repeat(np.cumsum(rest) - rest, rest)
            place = begin[lead]
            end[inside] = np.repeat(place, rest)
            begin[inside] = end[inside]
            begin[lead + rest] = place
            end[lead + rest] = source[start[lead] + rest + 1]
        return begin, end

    def pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids, first bytes and ends of the pieces of texts, and the place of each text's first piece."""
        normalised = [self.normalise(t) for t in texts]
        if not self.spells:
            return self._unspelled(normalised)
        ids, bounds = self.segment([n for n, _ in normalised])
        spans = [self.spans(ids[a:b], s) for a, b, (_, s) in zip(bounds, bounds[1:], normalised, strict=False)]
        return ids, *(np.concatenate(x) for x in zip(*spans, strict=True)), bounds

    def _unspelled(self, normalised: list[tuple[bytes, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A model that spells nothing in bytes has unknown pieces of any length; the library tells where they end."""
        found = [self.segmenter.encode(n.decode(), return_type="proto").pieces for n, _ in normalised]
        flat = [(p.id, int(s[p.begin]), int(s[p.end])) for part, (_, s) in zip(found, normalised, strict=True) for p in part]
        columns = np.array(flat, np.int64).reshape(-1, 3).T
        return *columns, np.cumsum([0, *map(len, found)])


def parts(batch: pa.RecordBatch, column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have about ``limit`` bytes, or one longer text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


_models: dict[str, Model] = {}


def model_of(path: str) -> Model:
    if path not in _models:
        _models[path] = Model(path)
    return _models[path]


def encode(
    docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = True
) -> DataFrame:
    """``(id_col, ids, starts, ends, decoded)`` of every row: the ids that the library gives for the text without begin or
    end ids, the span of each in bytes of the text's UTF-8 form, and the text that the library decodes the ids to.

    ``model`` is a path that every executor has, like the library itself. A null text is empty; an empty text has no ids
    and decodes to an empty text. Null and repeated ids pass through, a row each; other columns are not read. An empty
    table gives no rows. Texts are whole; a task holds one at a time besides its Arrow batch.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    names = ["id", "ids", "starts", "ends", *(["decoded"] if decoded else [])]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = model_of(model)
        for batch in batches:
            for part in parts(batch, 1, PART):
                ids, starts, ends, bounds = coder.pieces([t or "" for t in part.column(1).to_pylist()])
                offsets = pa.array(bounds, pa.int32())
                columns = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (ids, starts, ends)]
                if decoded:
                    flat, edges = ids.tolist(), bounds.tolist()
                    back = coder.library.decode([flat[a:b] for a, b in zip(edges, edges[1:], strict=False)])
                    columns.append(pa.array(back, pa.string()))
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=names)

    schema = f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>, starts array<int>, ends array<int>"
    found = rows.mapInArrow(pieces, schema + (", decoded string" if decoded else ""))
    return found.withColumnRenamed("id", id_col)
