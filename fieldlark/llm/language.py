"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of all training texts sparsely in each task, and Spark sums them by (language, bucket). The
log-probability matrix is broadcast in blocks of languages of at most MATRIX numbers each. Scoring turns the texts into a sparse
matrix of (document, bucket) counts, PIECE n-grams at a time, and multiplies it by the log-probability matrix; a text of any length
is cut into stretches that overlap by what an n-gram reaches over, and their scores add up.

A null text, or one without a letter, is `und` with score 0. Without any training language every text is `und`. Ties go to
the language that sorts first. Labels that are null teach nothing. Repeated rows get equal results. A very long text
needs no more memory than a short one. Extra columns are not read, whatever their names; `identified` gives them back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _text as T
from ._spark import table
from .quality import held_out

#: Hash buckets of n-grams (a power of two), orders of n-grams, added count.
BUCKETS, ORDERS, ALPHA = 1 << 14, (2, 3), 0.5
#: n-grams that are counted at once, numbers of the log-probability matrix that are broadcast at once (single floats, 64 MB).
PIECE, MATRIX = 1 << 16, 1 << 24
#: Texts that are scored together, and numbers of gathered matrix rows that are held at once.
STEP, CELLS = 1000, 1 << 20
#: n-grams after which more text adds no further certainty to a score.
EVIDENCE = 64
_TOP = 0x33480  # past the last assigned letters
_FOLD = np.full(_TOP + 1, 32, np.uint32)
for _c in range(_TOP):
    if (_s := chr(_c)).isalpha():
        _FOLD[_c] = ord(_s.lower()) if len(_s.lower()) == 1 else _c
_ODD = (np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)) | np.uint64(1)


def _stretches(raw: np.ndarray) -> Iterator[tuple[int, int]]:
    """(from, to) of stretches of about PIECE bytes that end between characters."""
    lo = 0
    while lo < len(raw):
        hi = min(lo + PIECE, len(raw))
        while hi < len(raw) and raw[hi] & 0xC0 == 0x80:
            hi += 1
        yield lo, hi
        lo = hi


def grams(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, buckets of the n-grams with a letter, the row of each from there, letters by row), PIECE bytes or so at a time.

    A text begins and ends with a blank, so that its first and last letters show. A long text comes in several parts.
    """
    for row, raw, at in T.chunks(column):
        if len(raw) <= PIECE or len(at) > 2:
            lo = 0
            while lo < len(at) - 1:  # whole texts, together as long as a piece, or one of them
                hi = max(lo + 1, int(np.searchsorted(at, at[lo] + PIECE, "right")) - 1)
                part = raw[at[lo] : at[hi]]
                yield from _parts(row + lo, part, at[lo : hi + 1] - at[lo])
                lo = hi
        else:
            yield from _parts(row, raw, at)


def _parts(row: int, raw: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    if len(raw) <= PIECE or len(at) > 2:
        code = _folded(raw)
        at = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))[at]
        text = np.insert(code, at, 32)
        at = at + np.arange(len(at))
        yield (row, *_hashed(text, at, 0))
        return
    before = np.full(1, 32, np.uint32)
    for lo, hi in _stretches(raw):
        end = np.full(int(hi == len(raw)), 32, np.uint32)
        text = np.concatenate((before, _folded(raw[lo:hi]), end))
        old = len(before) if lo else 0
        # the blank that ends the text stands where `_hashed` expects that of the next text
        at = np.array([0, len(text) - 1 if len(end) else len(text)])
        yield (row, *_hashed(text, at, old))
        before = text[-(max(ORDERS) - 1) :]


def _folded(raw: np.ndarray) -> np.ndarray:
    code = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    return _FOLD[np.minimum(code, _TOP)]


def _hashed(text: np.ndarray, at: np.ndarray, old: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets and rows of all n-grams of `text` that end after its first `old` characters, and new letters by row; `at`: the blanks before the rows, and the end."""
    letter = text != 32
    total = np.concatenate(([0], np.cumsum(letter)))
    found, place = [], []
    for n in ORDERS:
        m = len(text) - n + 1
        if m <= 0:
            continue
        ok = letter[:m].copy()
        for j in range(1, n):
            ok |= letter[j : m + j]
        for back in range(1, n - 1):  # where an n-gram would reach over the blank that ends its text
            edge = at[1:] - back
            ok[edge[(edge >= 0) & (edge < m)]] = False
        ok[: max(0, old - n + 1)] = False
        where = np.flatnonzero(ok)
        h = text[where] * _ODD[0]
        for j in range(1, n):
            h = h + text[where + j] * _ODD[j]
        found.append((T.mix(h + np.uint64(n)) & np.uint64(BUCKETS - 1)).astype(np.int64))
        place.append(np.searchsorted(at, where, "right") - 1)
    bucket = np.concatenate(found) if found else np.zeros(0, np.int64)
    of = np.concatenate(place) if place else np.zeros(0, np.int64)
    edges = np.minimum(np.maximum(at, old), len(text))
    return bucket, np.minimum(of, len(at) - 2), total[edges[1:]] - total[edges[:-1]]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """This task's counts by (language, bucket), given out whenever they are many."""
    total: dict[str, np.ndarray] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for name, counts in total.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(counts[at])], names=["lang", "bucket", "n"])
        total.clear()

    for batch in batches:
        names, code = np.unique(np.array(batch.column(1).to_pylist(), object).astype(str), return_inverse=True)
        for row, bucket, of, _ in grams(batch.column(0)):
            key, n = np.unique(code[row + of] * BUCKETS + bucket, return_counts=True)
            for c in np.unique(key // BUCKETS).tolist():
                own = slice(*np.searchsorted(key, (c * BUCKETS, (c + 1) * BUCKETS)))
                if names[c] not in total:
                    total[names[c]] = np.zeros(BUCKETS, np.int64)
                total[names[c]][key[own] - c * BUCKETS] += n[own]
            if len(total) * BUCKETS > MATRIX:
                yield from out()
    yield from out()


def train(documents: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """The languages in order, and log P(bucket | language) with uniform priors, from all rows given.

    The driver gets a row of BUCKETS counts for each language, whatever the number of documents.
    """
    rows = documents.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    sums = rows.mapInArrow(_counted, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = sums.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("x")).orderBy("lang").collect()  # BUCKETS pairs at most of each
    counts = np.full((len(found), BUCKETS), ALPHA)
    for own, r in zip(counts, found, strict=True):
        at, n = np.array(r["x"], np.int64).reshape(-1, 2).T
        own[at] += n
    return [r["lang"] for r in found], np.log(counts / counts.sum(1, keepdims=True)).astype(np.float32).T.copy()


class Scorer:
    """The broadcast matrix, in blocks of languages that a task holds one after the other."""

    def __init__(self, spark: SparkSession, names: list[str], matrix: np.ndarray):
        self.names, wide = names, max(1, MATRIX // BUCKETS)
        self.blocks = [spark.sparkContext.broadcast(matrix[:, i : i + wide].copy()) for i in range(0, len(names), wide)]

    def __call__(self, column: pa.Array) -> tuple[pa.Array, pa.Array]:
        return classified(column, self.names, [b.value for b in self.blocks])


def predict(documents: DataFrame, names: list[str], matrix: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row."""
    model = Scorer(documents.sparkSession, names, matrix)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), *model(batch.column(1))], names=["doc_id", "lang_pred", "score"])

    return documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")


def classified(column: pa.Array, names: list[str], blocks: list[np.ndarray]) -> tuple[pa.Array, pa.Array]:
    """The best language of each text, `und` without letters, and its posterior."""
    best, score = np.full(len(column), len(names)), np.zeros(len(column))
    for lo in range(0, len(column), STEP):
        part = column.slice(lo, STEP)
        log, many, letters = np.zeros((len(part), len(names))), np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
        for row, bucket, of, new in grams(part):
            letters[row : row + len(new)] += new
            if not len(bucket) or not names:
                continue
            many[row : row + len(new)] += np.bincount(of, minlength=len(new))
            key, n = np.unique(of * BUCKETS + bucket, return_counts=True)  # the sparse rows of these texts
            doc, at = key // BUCKETS, key % BUCKETS
            first = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
            left = 0
            for m in blocks:
                step = max(1024, CELLS // m.shape[1])
                for x in range(0, len(key), step):  # rows of the matrix that are held at once
                    begin = np.unique(np.concatenate(([x], first[(first > x) & (first < x + step)])))
                    sums = np.add.reduceat(m[at[x : x + step]] * n[x : x + step, None].astype(np.float32), begin - x, axis=0, dtype=np.float64)
                    log[row + doc[begin], left : left + m.shape[1]] += sums
                left += m.shape[1]
        some = np.flatnonzero((many > 0) & (letters > 0))
        if names and len(some):
            # a document's evidence counts as EVIDENCE n-grams at most: neighbours overlap and aren't independent
            log = log[some] * np.minimum(1, EVIDENCE / many[some])[:, None]
            p = np.exp(log - log.max(1, keepdims=True))
            best[lo + some], score[lo + some] = p.argmax(1), p.max(1) / p.sum(1)
    return pa.array([*names, "und"]).take(pa.array(best)), pa.array(score)


def identified(documents: DataFrame, names: list[str], matrix: np.ndarray, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose language is identified with a score of at least `least`."""
    model = Scorer(documents.sparkSession, names, matrix)

    @F.arrow_udf("double")
    def certainty(text: pa.Array) -> pa.Array:
        return model(text)[1]  # 0 for `und`

    return documents.where(certainty(F.col(text_col).cast("string")) >= least)


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; learnt from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    names, matrix = train(docs.where(~held_out(3, 1) & F.col("doc_id").isNotNull()))
    return predict(docs, names, matrix).select("doc_id", held_out(3, 1).alias("held_out"), "lang_pred", "score")
