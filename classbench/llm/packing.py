"""Packing documents into token windows by Karmarkar-Karp multiway differencing.

One pass without a shuffle: each task tokenizes its own rows, cuts whole windows
off long documents at once and gathers the rest, cut into pieces of at most
``max_piece`` ids, into groups of ``group_docs`` documents.  A group is dealt to
``k`` windows by multiway differencing: partial partitions of opposing imbalance
are merged until one is left; ``k`` rises while a window exceeds the capacity.
A lost task repeats its own rows alone, with the same windows.

Defined results: a null text is empty and yields the end id alone; repeated rows
are packed as often as they come; an empty table yields no rows; columns other
than the two that are named are not read, so their names cannot clash.
"""

from __future__ import annotations

import heapq
import re
import sys
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from classbench.session import ship_by_value

#: Cached words in each of the two halves of a Python worker's cache.
CACHE_WORDS = 400_000
#: Words that go straight to the BPE model: letters whose lower case is one letter and which NFC leaves alone.
LATIN_WORD = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")


class WordTokenizer(dict):
    """Ids of white-space separated chunks, learnt when they are first looked up.

    The tokenizer's own pre-tokens never span ASCII white space, so a text's ids
    are those of its chunks.  A word of Latin letters goes straight to the BPE
    model (after the lower-casing and byte mapping that the tokenizer would
    apply), any other chunk through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model.tokenize
        self.older: dict[bytes, bytes] = {}
        self.coded = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.marks = {m: self._encode(m) for m in (b",", b".")}
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        mapped = "".join(level.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100))
        self.table = dict(zip((b for c in range(0xC0, 0x100) for b in chr(c).encode()), mapped))

    def _encode(self, chunk: bytes) -> bytes:
        return b"".join([self.coded[i] for i in self.tokenizer.encode(chunk.decode(), add_special_tokens=False).ids])

    def __missing__(self, chunk: bytes) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            mark = self.marks.get(chunk[-1:], b"")  # an ASCII mark that ends a word is a token of its own
            word = (chunk[:-1] if mark else chunk).decode()
            if LATIN_WORD.fullmatch(word):
                word = word.lower()
                if not word.isascii():
                    word = word.encode().decode("latin-1").translate(self.table)
                ids = b"".join([self.coded[t.id] for t in self.model(word)]) + mark
            else:
                ids = self._encode(chunk)
        self[chunk] = ids
        return ids

    def ids(self, texts: list[str | None]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        for text in texts:
            if len(self) > CACHE_WORDS:  # frequent chunks come back from the older half
                self.older = dict(self)
                self.clear()
            yield b"".join(map(self.__getitem__, (text or "").encode().split()))


def word_tokenizer(path: str) -> WordTokenizer:
    """The worker's tokenizer with its words: functions are shipped anew with each task, ``sys.modules`` stays."""
    kept = sys.modules.setdefault("_packing_tokenizers", ModuleType("_packing_tokenizers")).__dict__
    if path not in kept:
        kept[path] = WordTokenizer(path)
    return kept[path]


def karmarkar_karp(weights: list[int], k: int) -> np.ndarray:
    """Window of each weight when ``k`` windows are filled by multiway differencing."""
    if k == 1 or not weights:
        return np.zeros(len(weights), int)
    heap, sums, merged = [], {}, {}
    for i, w in enumerate(weights):
        sums[i] = np.zeros(k, np.int64)
        sums[i][0] = w
        heap.append((-w, i))
    heapq.heapify(heap)
    node = len(weights)
    while len(heap) > 1:  # the two widest spreads, largest windows of one onto smallest of the other
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        total = sums.pop(a) + sums.pop(b)[::-1]
        order = np.argsort(-total, kind="stable")
        place = np.empty(k, np.int32)
        place[order] = np.arange(k, dtype=np.int32)
        sums[node], merged[node] = total[order], (a, b, place)
        heapq.heappush(heap, (-int(sums[node][0] - sums[node][-1]), node))
        node += 1
    window, stack = np.zeros(len(weights), int), [(heap[0][1], np.arange(k))]
    while stack:
        at, slots = stack.pop()
        if at < len(weights):
            window[at] = slots[0]
        else:
            a, b, place = merged.pop(at)
            stack += [(a, slots[place]), (b, slots[place[::-1]])]
    return window


def fill_windows(weights: list[int], capacity: int) -> np.ndarray:
    """Near-equal windows within ``capacity``; their number rises until none exceeds it."""
    k = max(1, -(-sum(weights) // capacity))
    while True:
        window = karmarkar_karp(weights, k)
        if not weights or np.bincount(window, weights=weights).max() <= capacity:
            return window
        k += max(1, k // 200)


def _even_cuts(n: int, most: int) -> list[int]:
    """Lengths of the fewest pieces of at most ``most`` that ``n`` ids can be cut into, nearly equal."""
    parts = -(-n // most)
    return [n // parts + (i < n % parts) for i in range(parts)] if n else []


def _packer(tokenizer_path: str, window: int, eos: int, max_piece: int, group_docs: int, schema: pa.Schema):
    end = np.array([eos], "<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, base, made = word_tokenizer(tokenizer_path), TaskContext.get().partitionId() << 33, 0
        rows: list[tuple] = []  # doc, start, ids, doc_tokens, sequence, offset
        waiting: list[tuple] = []  # pieces that share windows
        waiting_docs = 0

        def flush():
            nonlocal made, waiting, waiting_docs
            at = fill_windows([len(p[2]) // 4 for p in waiting], window)
            filled: dict[int, int] = {}
            number = {w: made + i for i, w in enumerate(dict.fromkeys(at.tolist()))}
            made += len(number)
            for p, w in zip(waiting, at.tolist()):
                rows.append((*p, base + number[w], filled.get(w, 0)))
                filled[w] = filled.get(w, 0) + len(p[2]) // 4
            waiting, waiting_docs = [], 0

        def emit():
            nonlocal rows
            cols = list(zip(*rows)) if rows else [()] * 6
            doc, start, ids, total, seq, off = cols
            rows = []
            return pa.RecordBatch.from_arrays(
                [pa.array(doc, schema.field(0).type), pa.array(start, pa.int64()),
                 pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
                 pa.array(total, pa.int64()), pa.array(seq, pa.int64()), pa.array(off, pa.int64())], schema=schema)

        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                docs = part.column(0).to_pylist()
                for doc, ids in zip(docs, words.ids(part.column(1).to_pylist())):
                    ids += end
                    n, at = len(ids) // 4, 0
                    while n - at >= window:
                        rows.append((doc, at, ids[4 * at:4 * (at + window)], n, base + made, 0))
                        made, at = made + 1, at + window
                    for length in _even_cuts(n - at, max_piece):
                        waiting.append((doc, at, ids[4 * at:4 * (at + length)], n))
                        at += length
                    waiting_docs += 1
                    if waiting_docs >= group_docs:
                        flush()
                if len(rows) >= 512:
                    yield emit()
        if waiting:
            flush()
        if rows:
            yield emit()

    return pieces


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = 2048,
         eos: int = 1, max_piece: int = 512, group_docs: int = 512) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    Memory of a task: one group's ids (about ``group_docs`` times ``window`` ids at
    most) and the word cache.  Sequences are unique by partition and counter.
    """
    ship_by_value(sys.modules[__name__])
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, kind)] + [
        T.StructField(n, t) for n, t in (("start", T.LongType()), ("length", T.LongType()), ("ids", T.BinaryType()),
                                         ("doc_tokens", T.LongType()), ("sequence_id", T.LongType()), ("offset", T.LongType()))])
    from pyspark.sql.pandas.types import to_arrow_schema

    # plain Python values only: the closure must not hold Spark objects
    arrow = to_arrow_schema(schema)
    return docs.select(id_col, text_col).mapInArrow(
        _packer(tokenizer_path, window, eos, max_piece, group_docs, arrow), schema)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def digests(pieces: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The pieces with the CRC-32 of their ids in place of the ids."""
    return pieces.select(id_col, "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_packing(spark, sf_dir) -> DataFrame:
    """All documents in windows of 2048 ids."""
    from classbench.llm.common import read_table

    return digests(pack(read_table(spark, sf_dir, "documents"), default_tokenizer()))
