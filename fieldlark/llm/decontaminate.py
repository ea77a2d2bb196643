"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

Items are partitioned by the number of their word shingles, in powers of two. An item of q shingles is contained in a
document if the document has at least t*q of them, so it can miss q - ceil(t*q) at most: of any q - ceil(t*q) + 1 shingles of
the item it has one. Each partition keeps that many of the smallest hash values (a bottom-k MinHash sketch whose k fits
the partition's largest size). A document is compared with an item only if it holds a value of the item's
sketch, which no contained item escapes; then the shared shingles are counted exactly.

Documents of any length are searched whole, in one pass that only reads them. Sketches and item sets are broadcast
in blocks of at most MOST_SHINGLES shingles; a larger benchmark takes several passes.

Words are runs of letters and digits (and all non-ASCII characters) with A-Z folded. Items of fewer than k words are one
shingle of all their words, and found where a document has these words in a row. Null or wordless items, null
item ids and null texts match nothing. Repeated rows are reported once each pair. Ids keep their own type. Very long texts
are hashed in pieces. Empty tables give no pair. Extra columns are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import _text as T
from ._spark import stored, table

#: Shingles of items that are broadcast at a time (8 bytes each), and items that are counted together.
MOST_SHINGLES, TOGETHER = 2_000_000, 1000


def _item_sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets, count = [], []
        for _, raw, at in T.chunks(batch.column(1)):
            w, first, _, _ = T.words(raw, at, T.NONWORD)
            sets += [np.unique(s) for s in T.shingles(w, first, k)]
            count += np.diff(first).tolist()
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([min(c, k) for c in count], pa.int32()), pa.array([len(s) for s in sets], pa.int32()), pa.array([s.tobytes() for s in sets], pa.binary())],
            names=["item_id", "width", "q", "set"],
        )


def _index(items: list, t: float) -> dict[int, tuple]:
    """For each window width: sketch values in order, their items (by offsets), the items' sets, their sizes, the ids."""
    index = {}
    for width in {r["width"] for r in items}:
        rows = [r for r in items if r["width"] == width]
        sets = [np.frombuffer(r["set"], np.uint64) for r in rows]
        value, item = [], []
        for i, s in enumerate(sets):
            largest = (1 << len(s).bit_length()) - 1  # of the partition
            k = largest - math.ceil(t * largest - 1e-9) + 1
            value.append(s[:k])  # sets are sorted by hash: these are the smallest
            item.append(np.full(len(s[:k]), i))
        v, it = np.concatenate(value), np.concatenate(item)
        order = np.argsort(v, kind="stable")
        keys, first = np.unique(v[order], return_index=True)
        index[width] = (keys, np.append(first, len(v)), it[order], sets, [r["item_id"] for r in rows])
    return index


def _pairs(column: pa.Array, index: dict[int, tuple], k: int, t: float) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, window width, item, shared shingles, the item's shingles) of every text and item it contains."""
    for row, raw, at in T.chunks(column):
        w, first, _, _ = T.words(raw, at, T.NONWORD)
        for width, (keys, begin, item, sets, _) in index.items():
            # a narrower window over the whole text is that of items with fewer than k words
            rows = T.shingles(w, first, width) if width == k else _narrow(w, first, width)
            flat = np.concatenate(rows) if rows else w[:0]
            if not len(flat):
                continue
            edge = np.concatenate(([0], np.cumsum([len(s) for s in rows])))
            place = np.minimum(np.searchsorted(keys, flat), len(keys) - 1)
            hit = np.flatnonzero(keys[place] == flat)
            doc = np.searchsorted(edge, hit, "right") - 1
            for d in np.unique(doc).tolist():
                own = np.unique(rows[d])
                near = np.unique(np.concatenate([item[begin[p] : begin[p + 1]] for p in np.unique(place[hit[doc == d]]).tolist()]))
                for part in np.split(near, range(TOGETHER, len(near), TOGETHER)):  # many items may share a passage: counted together
                    size = np.array([len(sets[i]) for i in part.tolist()])
                    s = np.concatenate([sets[i] for i in part.tolist()])
                    there = own[np.minimum(np.searchsorted(own, s), len(own) - 1)] == s
                    shared = np.add.reduceat(there, np.cumsum(size) - size, dtype=np.int64)
                    for j in np.flatnonzero(shared >= np.ceil(t * size - 1e-9)).tolist():
                        yield row + d, width, int(part[j]), int(shared[j]), int(size[j])


def _searched(batches: Iterator[pa.RecordBatch], index, k: int, t: float, kinds: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = list(_pairs(batch.column(1), index.value, k, t))
        names = pa.array([index.value[width][4][i] for _, width, i, _, _ in found], kinds[1])
        cols = [batch.column(0).take(pa.array([x[0] for x in found], pa.int64())), names, *(pa.array([x[c] for x in found], pa.int64()) for c in (3, 4))]
        yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "item_id", "shared", "item_shingles"])


def _narrow(w: np.ndarray, first: np.ndarray, width: int) -> list[np.ndarray]:
    """Hashes of all windows of fewer than k words, as a text of just these words would have."""
    if len(w) < width:
        return [w[:0]] * (len(first) - 1)
    m = len(w) - width + 1
    s = T.mix(sum((w[j : m + j] * T._POS[j] for j in range(1, width)), w[:m] * T._POS[0]) + np.uint64(width) * T._POS[7])
    return [s[lo : max(lo, hi - width + 1)] for lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]


def _indexes(benchmark: DataFrame, k: int, threshold: float, item_col: str, item_text: str) -> Iterator:
    """Broadcast indexes of blocks of items, about MOST_SHINGLES shingles each; one at least."""
    items = benchmark.where(F.col(item_col).isNotNull()).select(F.col(item_col).alias("item_id"), F.col(item_text).cast("string").alias("text"))
    kind = items.schema["item_id"].dataType.simpleString()
    sets = stored(items.mapInArrow(lambda b: _item_sets(b, k), f"item_id {kind}, width int, q int, set binary").where("q > 0").distinct())
    whole = sets.agg(F.sum("q").alias("q")).first()["q"] or 0
    blocks = max(1, math.ceil(whole / MOST_SHINGLES))
    for block in range(blocks):
        rows = sets.where(F.pmod(F.xxhash64("item_id", "set"), F.lit(blocks)) == block).collect()
        yield benchmark.sparkSession.sparkContext.broadcast(_index(rows, threshold))


def contained_items(documents: DataFrame, benchmark: DataFrame, k: int = 5, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, shared, item_shingles, containment): every item that a document contains at least to `threshold`."""
    docs = documents.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kinds = [docs.schema["doc_id"].dataType, benchmark.schema[item_col].dataType]
    schema = f"doc_id {kinds[0].simpleString()}, item_id {kinds[1].simpleString()}, shared long, item_shingles long"
    found, arrow = None, [to_arrow_type(x) for x in kinds]
    for index in _indexes(benchmark, k, threshold, item_col, item_text):
        part = docs.mapInArrow(lambda b, index=index: _searched(b, index, k, threshold, arrow), schema)
        found = part if found is None else found.unionAll(part)
    return found.groupBy("doc_id", "item_id").agg(F.max("shared").alias("shared"), F.max("item_shingles").alias("item_shingles")).withColumn("containment", F.col("shared") / F.col("item_shingles"))


def clean(documents: DataFrame, benchmark: DataFrame, k: int = 5, threshold: float = 0.8, text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text contains no item; ids aren't looked at."""
    out = documents
    for index in _indexes(benchmark, k, threshold, item_col, item_text):
        out = out.where(~_contaminated(index, k, threshold)(F.col(text_col).cast("string")))
    return out


def _contaminated(index, k: int, threshold: float):
    @F.arrow_udf("boolean")
    def contaminated(text: pa.Array) -> pa.Array:
        hit = np.zeros(len(text), bool)
        hit[[x[0] for x in _pairs(text, index.value, k, threshold)]] = True
        return pa.array(hit)

    return contaminated


def op10_contained_items(spark, sf_dir: str) -> DataFrame:
    """doc_id, item_id, shared, item_shingles of every benchmark item in every document."""
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select("doc_id", "item_id", "shared", "item_shingles")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents WHERE doc_id IS NOT NULL),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
ds AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) AS s FROM d WHERE len(w) >= 5),
bs AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) AS s FROM b WHERE len(w) >= 5),
q AS (SELECT item_id, count(*) AS item_shingles FROM bs GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS shared, any_value(item_shingles) AS item_shingles
FROM ds JOIN bs USING (s) JOIN q USING (item_id)
GROUP BY doc_id, item_id HAVING 100 * count(*) >= 80 * any_value(item_shingles)
"""
