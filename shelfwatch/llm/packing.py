"""Order-preserving packing of tokenised documents by dynamic programming.

Documents keep the order in which Spark reads them and are packed per input partition, so nothing is
shuffled. A partition's ids are one long line; windows of at most ``size`` ids are cut from it. Cuts may fall
at document ends (free), at sentence ends, or, where a sentence is long, every ``stride`` ids inside it (dearer). With
``best[i]`` the least cost of the line up to cut point i,

    best[j] = price(j) + min over i with j - size <= i < j of best[i] + WINDOW + padding(j - i)

where ``padding(n)`` is 0 for a power of two and ``size - n`` otherwise. As ``size - (j - i)`` splits into a part
of i and a part of j, the minimum is that of a sliding window, kept by a monotone queue; the powers of two from
64 on are further transitions. Lines of about ``block`` ids, each ending with
a document, bound a task's memory besides the longest document.
"""

from __future__ import annotations

import base64
import os
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 6
SENTENCE = 2
INSIDE = 12
# One sentence end of each so many ids is enough; windows shorter than LEAST gain nothing from being unpadded.
THIN = 16
LEAST = 64
END_ID = 1
# Fixed value: the split of a text into pieces that belongs to the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_tokenizers: dict[tuple[str, str | None], _Ids] = {}


class _Ids:
    """Ids of texts as the ``tokenizers`` file gives them, special tokens' strings being special tokens as there.

    With ``ranks``, the same vocabulary as a rank file, ``tiktoken`` merges them: the ids are the same at less
    than half the time.
    """

    def __init__(self, path: str, ranks: str | None) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.ends = np.zeros(tokenizer.get_vocab_size(), bool)
        for token, k in tokenizer.get_vocab().items():
            self.ends[k] = token[-1] in ".!?Ċ"
        if ranks is None:
            self.encode = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
        else:
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            special = {t.content: k for k, t in tokenizer.get_added_tokens_decoder().items() if t.special}
            coder = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens=special)
            self.encode = lambda text: coder.encode(text, allowed_special="all")


def token_ids(path: str, ranks: str | None = None) -> _Ids:
    if (path, ranks) not in _tokenizers:
        _tokenizers[path, ranks] = _Ids(path, ranks)
    return _tokenizers[path, ranks]


def cut_points(ids: np.ndarray, doc_ends: np.ndarray, ends: np.ndarray, stride: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which a window may end, ascending, and the price of each; the last is the line's end."""
    sentence = np.flatnonzero(ends[ids]) + 1
    sentence = sentence[np.unique(sentence // THIN, return_index=True)[1]]
    price = {INSIDE: np.zeros(0, np.int64)}
    points = np.union1d(sentence, doc_ends)
    edges = np.r_[0, points]
    gaps = np.diff(edges)
    wide = np.flatnonzero(gaps > stride)
    if len(wide):
        counts = (gaps[wide] - 1) // stride
        first = np.repeat(edges[wide], counts)
        steps = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + 1
        price[INSIDE] = first + steps * stride
    points = np.union1d(points, price[INSIDE])
    cost = np.full(len(points), SENTENCE, np.int64)
    cost[np.searchsorted(points, price[INSIDE])] = INSIDE
    cost[np.searchsorted(points, doc_ends)] = 0
    return points, cost


def cuts(points: np.ndarray, cost: np.ndarray, size: int) -> list[int]:
    """Ends of the windows of least total cost, by the recurrence above. Gaps of ``points`` are at most ``size``."""
    places = [0, *points.tolist()]
    prices = [0, *cost.tolist()]
    n = len(places)
    best, came = [0] * n, [0] * n
    # Transitions over a power of two: for every point, the points that lie exactly so far before it.
    at = np.r_[0, points]
    powers = [k for k in range(size.bit_length()) if min(LEAST, size) <= 1 << k <= size]
    far = [np.searchsorted(at, at - (1 << k)) for k in powers]
    hits = [np.flatnonzero((at >= 1 << k) & (at[f] == at - (1 << k))) for k, f in zip(powers, far, strict=True)]
    exact: list[tuple[int, ...]] = [()] * n
    for f, hit in zip(far, hits, strict=True):
        for j, i in zip(hit.tolist(), f[hit].tolist(), strict=True):
            exact[j] += (i,)
    queue: deque[tuple[int, int]] = deque()
    for j in range(1, n):
        place, k = places[j], j - 1
        key = best[k] + places[k]
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, k))
        while places[queue[0][1]] < place - size:
            queue.popleft()
        key, source = queue[0]
        least = key + size - place
        for i in exact[j]:
            if best[i] < least:
                least, source = best[i], i
        best[j], came[j] = least + WINDOW + prices[j], source
    out, j = [], n - 1
    while j:
        out.append(places[j])
        j = came[j]
    return out[::-1]


def _pieces(lengths: np.ndarray, ends: list[int]) -> tuple[np.ndarray, ...]:
    """Document, start in it, length, window and offset of every piece of a line of documents cut at ``ends``."""
    doc_ends = np.cumsum(lengths)
    edges = np.union1d(doc_ends, ends)
    begin = np.r_[0, edges[:-1]]
    doc = np.searchsorted(doc_ends, begin, "right")
    window = np.searchsorted(ends, begin, "right")
    starts = np.r_[0, ends]
    return doc, begin - (doc_ends - lengths)[doc], edges - begin, window, begin - starts[window], begin


def pack(
    docs: DataFrame, tokenizer: str, ranks: str | None = None, id_col: str = "doc_id", text_col: str = "text",
    size: int = 2048, stride: int = 48, block: int = 1 << 19, with_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset`` (and ``ids``).

    A document is its text's ids, the strings of special tokens being those tokens, and id 1; a null or empty text is
    id 1 alone. Sequences hold at most ``size`` ids; ``sequence_id`` is the input partition's number times 2^33 plus
    the sequence's number in it. Rows with null or repeated ids are packed like others; other columns are
    not read. A text of any length is cut into as many sequences as it takes. An empty table gives no rows.
    """
    if size < 1 or size > 1 << 20 or stride < 1 or stride > size:
        raise ValueError("size must be 1 to 2^20 and stride 1 to size")
    docs = docs.select(F.col(id_col), F.col(text_col))
    id_type = docs.schema[0].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = token_ids(tokenizer, ranks)
        sequence = TaskContext.get().partitionId() << 33

        def flush(names: list, held: list[np.ndarray]) -> pa.RecordBatch:
            nonlocal sequence
            lengths = np.array([len(x) for x in held], np.int64)
            line = np.concatenate(held)
            points, cost = cut_points(line, np.cumsum(lengths), coder.ends, stride)
            ends = cuts(points, cost, size)
            doc, start, length, window, offset, begin = _pieces(lengths, ends)
            wide = line.astype("<u4", copy=False)
            crc = [zlib.crc32(wide[b : b + n]) for b, n in zip(begin.tolist(), length.tolist(), strict=True)]
            columns = [
                pa.concat_arrays(names).take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()),
                pa.array(lengths[doc]), pa.array(window + sequence), pa.array(offset),
            ]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(np.r_[begin, len(line)], pa.int32()), pa.array(line.astype(np.int32))))
            sequence += len(ends)
            return pa.RecordBatch.from_arrays(columns, names=schema_names)

        names, held, count = [], [], 0
        for batch in batches:
            for k, text in enumerate(batch.column(1)):
                ids = coder.encode(text.as_py() or "")
                names.append(batch.column(0).slice(k, 1))
                held.append(np.array([*ids, END_ID], np.uint32))
                count += len(ids) + 1
                if count >= block:
                    yield flush(names, held)
                    names, held, count = [], [], 0
        if held:
            yield flush(names, held)

    schema = (
        f"`{id_col}` {id_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
        "offset bigint"
    ) + (", ids array<int>" if with_ids else "")
    schema_names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    return docs.mapInArrow(rows, schema)
