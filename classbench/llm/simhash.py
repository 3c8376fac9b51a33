"""SimHash near-duplicates by anchor-point covering.

Anchors are the codewords of the Hamming code on the first 63 bits of a
fingerprint, together with the last bit as it is: a perfect code, so every
fingerprint lies within covering radius 1 of exactly one anchor, its home.  Two
fingerprints within ``t`` bits have a point between them within ``ceil(t / 2)``
bits of both, and share that point's home.  So each fingerprint is replicated to
the homes of all points within ``ceil(t / 2)`` bits - the anchors within covering
radius plus its half of the threshold (33 of them for t = 2) - and compared there.

A cell holds only fingerprints within that distance of its anchor, so its size
is bounded by the code (about 4,000 for t = 2), not by the data.  Equal
fingerprints are one row before they are replicated, and a cell yields one
link for each member, not all pairs.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from classbench.llm.common import hex64, let, long_array, materialize, read_table
from classbench.llm.components import connected_components
from classbench.session import ship_by_value

SEED = 42


def fingerprint_of(text: str | None, shingle: int) -> int:
    """64-bit SimHash of a text's word shingles, as a signed long; no word gives zero."""
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: A-Z alone and ASCII white space alone
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = [0, *(ends[:-1] + 1).tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:].tolist())]
    n, ones = len(hashes), np.zeros(64, np.int64)
    for first in range(0, n, 65536):
        part = np.array(hashes[first:first + 65536], "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def _flips(radius: int) -> list[int]:
    """All masks of at most ``radius`` of 64 bits."""
    masks = {0}
    for _ in range(radius):
        masks |= {m ^ (1 << b) for m in masks for b in range(64)}
    return sorted(masks)


def _syndrome(mask: int) -> int:
    """Exclusive or of the positions (1 to 63) of the set bits among the first 63."""
    s = 0
    for b in range(63):
        if mask >> b & 1:
            s ^= b + 1
    return s


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def anchors(fingerprint: str, max_bits: int) -> F.Column:
    """Homes of all points within half of ``max_bits``, rounded up, of a fingerprint."""
    parity = [sum(1 << b for b in range(63) if (b + 1) >> j & 1) for j in range(6)]
    own = " | ".join(f"shiftleft(bit_count({fingerprint} & {m}L) & 1, {j})" for j, m in enumerate(parity))
    masks = _flips(-(-max_bits // 2))
    fix = long_array([0, *(1 << b for b in range(63))])  # the bit that a syndrome names
    steps = F.arrays_zip(long_array(map(_signed, masks)).alias("mask"), long_array(map(_syndrome, masks)).alias("syndrome"))
    return let(F.struct(F.expr(own).alias("s"), F.col(fingerprint).alias("f")), lambda p: F.array_distinct(F.transform(
        steps, lambda z: p["f"].bitwiseXOR(z["mask"]).bitwiseXOR(
            F.get(fix, p["s"].cast("long").bitwiseXOR(z["syndrome"]).cast("int"))))))


def differing_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of signed longs (``bitwise_count`` alone counts those of the absolute value)."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def cell_links(values: np.ndarray, max_bits: int) -> tuple[list[int], list[int]]:
    """For each member of a cell that others reach in it, a link to the smallest member so reached."""
    n = len(values)
    if n == 2:
        near = int(differing_bits(values[:1], values[1:])[0]) <= max_bits
        return ([int(values.max())], [int(values.min())]) if near else ([], [])
    left, ends, roots = np.ones(n, bool), [], []
    values = np.sort(values)
    for i in range(n):
        if not left[i]:
            continue
        left[i], front = False, [i]
        while front:
            rest = np.flatnonzero(left)
            if not len(rest):
                break
            some = np.array(front[-256:])
            del front[-256:]
            close = (differing_bits(values[some][:, None], values[rest][None, :]) <= max_bits).any(0)
            found = rest[close]
            left[found] = False
            front += found.tolist()
            ends += values[found].tolist()
            roots += [int(values[i])] * len(found)
    return ends, roots


def _linker(max_bits: int, schema: pa.Schema):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by anchor; the last cell of a batch waits for the next batch."""
        cell, value = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def links(cell, value):
            cuts = np.flatnonzero(np.diff(cell)) + 1
            bounds = np.concatenate([[0], cuts, [len(cell)]])
            sizes = np.diff(bounds)
            a, b = [], []
            pairs = bounds[:-1][sizes == 2]  # most cells with company have two members
            x, y = value[pairs], value[pairs + 1]
            near = differing_bits(x, y) <= max_bits
            a += np.maximum(x, y)[near].tolist()
            b += np.minimum(x, y)[near].tolist()
            for i in np.flatnonzero(sizes > 2):
                ends, roots = cell_links(value[bounds[i]:bounds[i + 1]], max_bits)
                a += ends
                b += roots
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=schema)

        for batch in batches:
            cell = np.concatenate([cell, batch.column(0).to_numpy(zero_copy_only=False)])
            value = np.concatenate([value, batch.column(1).to_numpy(zero_copy_only=False)])
            earlier = np.flatnonzero(cell != cell[-1]) if len(cell) else []
            done = int(earlier[-1]) + 1 if len(earlier) else 0
            if done:
                yield links(cell[:done], value[:done])
                cell, value = cell[done:], value[done:]
        if len(cell):
            yield links(cell, value)

    return link


def near_links(prints: DataFrame, max_bits: int) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints within ``max_bits`` of each other (column fp)."""
    ship_by_value(sys.modules[__name__])
    cells = prints.select("fp", F.explode(anchors("fp", max_bits)).alias("anchor")).select("anchor", "fp")
    dealt = cells.repartition("anchor").sortWithinPartitions("anchor")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    return dealt.mapInArrow(_linker(max_bits, schema), "a long, b long")


def fingerprints(docs: DataFrame, shingle: int, text_col: str = "text"):
    """Column of SimHash fingerprints (signed longs) of a text column."""
    ship_by_value(sys.modules[__name__])

    @F.pandas_udf("long")
    def simhash(text: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t, shingle) for t in text], dtype="int64")

    return simhash(docs[text_col])


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id, fp, component): one row for each row of ``docs``; component is the smallest id reachable.

    Defined results: a null text is empty, an empty text has fingerprint zero and
    is linked like any other; rows with a null id get the component of their
    fingerprint and name none; repeated rows and ids repeat; a component of null
    ids alone is null; an empty table yields no rows.  Other columns are not
    read, so their names cannot clash.
    """
    rows = materialize(docs.select(F.col(id_col).alias("id"), fingerprints(docs, shingle, text_col).alias("fp")), "prints")
    prints = rows.groupBy("fp").agg(F.min("id").alias("least"))
    roots = materialize(connected_components(near_links(prints, max_bits)), "roots")
    rooted = prints.join(roots, prints.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    named = rooted.join(least, "root").select("fp", "component")
    return rows.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component")


def op3_simhash(spark, sf_dir) -> DataFrame:
    """Fingerprint and component of every document: 3-word shingles, at most 2 differing bits."""
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex64(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id"))
