"""Spelling variants: near words found by search schemes over a bidirectional FM-index of the vocabulary.

`vocabulary` counts the words of whole texts. `near_words` finds, for each word, the words that differ from it by exactly one
inserted, deleted or replaced code point: such a word shares the left half of the word as its beginning, or the right half as
its end. The index has two directions, each over the delimited vocabulary: one grows a match to the right, one to the left. A
search narrows the interval of suffix ranks by the delimiter and one half exactly, then goes on across the other half with one
error and ends at the delimiter. The vocabulary is dealt by the first (last) three code points, which every half holds, so that
a search meets only the part of the index that can answer it: small keys share a group, a key with more than CHUNK code points
is dealt into chunks, and each block of its words visits each chunk. Groups answer with a count and the best near word for each
of their words, never with pairs. `forms` names each word's form and follows forms to the root.

Nulls: a null text is an empty one; a null id stands as an empty one in the hash. Repeated rows count as often as they occur.
Empty tables, and texts without a word, give no rows. Texts are read in pieces of PIECE bytes, cut between words; a task's
memory grows with its longest repeated word (some 40 bytes a code point) and with CHUNK. Ties of n go to the smaller word.
Other columns of `docs` are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._spark import dropped, small, stored, table

#: Least code points and occurrences of a word; how much more frequent a form is; one run in ONE_IN loses a code point.
SHORTEST, LEAST, FORM, ONE_IN = 7, 2, 10, 31
#: Code points that select a group; every half of a word has them.
KEY = SHORTEST // 2
#: Code points of an index, delimiters included, that a chunk of one key aims at; queries that are searched together.
CHUNK, BATCH = 1 << 19, 20000
#: Bytes of text that are cut into words together, and distinct words that a task holds before it passes them on.
PIECE, HELD = 1 << 20, 100_000
#: Runs of A-Z, a-z and U+00C0 to U+00FF in UTF-8 after lower-casing A-Z, and a byte outside any run.
_RUN = re.compile(rb"(?:[a-z]+|(?:\xc3[\x80-\xbf])+)+")
_OUTSIDE = re.compile(rb"[^a-z\xc3\x80-\xbf]")
_END, _MARK = 0, 1  # codes of the text's end and of the delimiter; letters follow


def _pieces(text: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(text):
        cut = _OUTSIDE.search(text, at + PIECE) if at + PIECE < len(text) else None
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) of rows (id, text), summed over some documents each."""
    held: Counter[str] = Counter()

    def out() -> pa.RecordBatch:
        found = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
        held.clear()
        return found

    for batch in batches:
        for name, text in zip(batch.column(0), batch.column(1), strict=True):
            seed = zlib.crc32(f"{name.as_py() or ''}:".encode())
            for piece in _pieces((text.as_py() or "").encode().lower()):
                for run, n in Counter(_RUN.findall(piece)).items():
                    if len(run) < SHORTEST:
                        continue
                    word, h = run.decode(), zlib.crc32(run, seed)
                    if h % ONE_IN == 0:
                        gone = h % len(word)
                        word = word[:gone] + word[gone + 1 :]
                    if len(word) >= SHORTEST:
                        held[word] += n
                if len(held) > HELD:
                    yield out()
    yield out()


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of all words with at least LEAST occurrences."""
    read = docs.select(F.col(doc_id).cast("string").alias("id"), F.col(text).cast("string").alias("text"))
    return read.mapInArrow(count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)


class Index:
    """FM-index of delimited words, written backwards, so that a step to the left in the text goes right in a word.

    `step` narrows an interval of suffix ranks by one code: the rows of the sorted (code, rank) pairs of the transformed text
    that lie before (code, rank) are the ranks' places among all suffixes that begin with the code.
    """

    def __init__(self, words: list[str]):
        text = np.frombuffer(("\0" + "\0".join(words) + "\0").encode("latin-1"), np.uint8)[::-1]
        known, codes = np.unique(text, return_inverse=True)
        self.code = np.full(256, len(known) + 1, np.int64)  # a letter that the index lacks
        self.code[known] = np.arange(len(known)) + _MARK
        codes = np.append(codes + _MARK, _END)
        self.size = n = len(codes)
        self.letters = len(known) + 1
        self.ranks = _suffix_ranks(codes)
        before = codes[self.ranks - 1]
        order = np.argsort(before, kind="stable")
        self.before = before
        self.pairs = before[order] * (n + 1) + order
        self.marks = np.flatnonzero(codes == _MARK)
        self.words = len(words)

    def step(self, code: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.pairs, code * (self.size + 1) + at)

    def word(self, lo: np.ndarray) -> np.ndarray:
        """The place in the list of the word whose delimited form begins at these ranks."""
        return self.words - 1 - np.searchsorted(self.marks, self.ranks[lo])

    def next(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(which interval, code, lo, hi) of all intervals that one letter more gives."""
        size = hi - lo
        wide = np.flatnonzero(size > self.letters)
        narrow = np.flatnonzero((size > 0) & (size <= self.letters))
        at = np.repeat(lo[narrow] - np.concatenate(([0], np.cumsum(size[narrow])[:-1])), size[narrow]) + np.arange(size[narrow].sum())
        seen = np.unique(np.repeat(narrow, size[narrow]) * 256 + self.before[at])
        which = np.concatenate((seen >> 8, np.repeat(wide, self.letters)))
        code = np.concatenate((seen & 255, np.tile(np.arange(self.letters), len(wide))))
        keep = code > _MARK
        which, code = which[keep], code[keep]
        lo, hi = self.step(code, lo[which]), self.step(code, hi[which])
        keep = lo < hi
        return which[keep], code[keep], lo[keep], hi[keep]


def _suffix_ranks(codes: np.ndarray) -> np.ndarray:
    """The suffixes' starts in order, by doubling: eight codes first, then pairs of ranks."""
    n, k = len(codes), 1
    rank, bits = codes.astype(np.int64), int(codes.max()).bit_length()
    while bits * 2 <= 62 and k < 8:
        rank = (rank << bits) | np.append(rank[k:], np.zeros(min(k, n), np.int64))[:n]
        k, bits = 2 * k, 2 * bits
    while True:
        order = np.argsort(rank)
        ordered = rank[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        if new.max() == n - 1:
            return order
        rank = new * (n + 1) + np.append(new[k:] + 1, np.zeros(min(k, n), np.int64))[:n]
        k *= 2


def search(index: Index, queries: list[str], halves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the query, place of the near word) of all words that share the first `halves` code points and have one error after."""
    lengths = np.array([len(q) for q in queries], np.int64)
    first = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    letters = np.frombuffer(("\0".join(queries) + "\0").encode("latin-1"), np.uint8)  # each query ends with the delimiter
    codes = index.code[letters]
    lo, hi = np.zeros(len(queries), np.int64), np.full(len(queries), index.size)
    lo, hi = index.step(np.full_like(lo, _MARK), lo), index.step(np.full_like(hi, _MARK), hi)
    state = [np.zeros(0, np.int64)] * 4  # query, next place, lo, hi of matches that have had their error
    found, alive, j = [], np.arange(len(queries)), 0
    while len(alive) or len(state[0]):
        # exact matches of the first j code points, beyond the half: one error here
        off = alive[(halves[alive] <= j) & (j <= lengths[alive])]
        if len(off):
            c = codes[first[off] + j]
            which, code, a, b = index.next(lo[off], hi[off])
            other = code != c[which]
            which, a, b = which[other], a[other], b[other]
            inside = j < lengths[off]
            replaced = inside[which]
            last = np.where(halves[off] == j, -1, codes[first[off] + max(j - 1, 0)])
            gone = off[inside & (c != last)]
            more = [
                (off[which], np.full(len(which), j), a, b),
                (off[which][replaced], np.full(int(replaced.sum()), j + 1), a[replaced], b[replaced]),
                (gone, np.full(len(gone), j + 1), lo[gone], hi[gone]),
            ]
            state = [np.concatenate([s, *(m[i] for m in more)]) for i, s in enumerate(state)]
        # all go on by one code point, the exact ones up to their end
        alive = alive[j < lengths[alive]]
        c = codes[first[alive] + j]
        lo[alive], hi[alive] = index.step(c, lo[alive]), index.step(c, hi[alive])
        alive = alive[lo[alive] < hi[alive]]
        q, at, a, b = state
        c = codes[first[q] + at]
        a, b = index.step(c, a), index.step(c, b)
        live = a < b
        done = live & (at == lengths[q])
        if done.any():
            found.append((q[done], index.word(a[done])))
        live &= ~done
        state = [q[live], at[live] + 1, a[live], b[live]]
        j += 1
    return (np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])) if found else (np.zeros(0, np.int64),) * 2


def _answers(group: pa.Table) -> pa.Table:
    """Near words of a group's queries in its index, of one direction: (word, n_near, best n, best word)."""
    rightwards = group.column("side")[0].as_py() == 0
    rows = sorted(zip(group.column("word").to_pylist(), group.column("n").to_pylist(), group.column("role").to_pylist(), strict=True))
    listed = [(w, n) for w, n, role in rows if role != 1]
    asked = [w for w, _, role in rows if role != 0]
    out = {"word": [], "n_near": [], "best_n": [], "best": []}
    if listed and asked:
        turn = (lambda w: w) if rightwards else (lambda w: w[::-1])
        # a word's reverse stands in the index of the direction to the left, in the order of the words themselves
        index, ns = Index([turn(w) for w, _ in listed]), np.array([n for _, n in listed], np.int64)
        for lo in range(0, len(asked), BATCH):
            some = asked[lo : lo + BATCH]
            lengths = np.array([len(w) for w in some], np.int64)
            q, v = search(index, [turn(w) for w in some], lengths // 2 if rightwards else lengths - lengths // 2)
            if not rightwards:  # words that share both halves were found by the other direction
                new = np.fromiter((not listed[b][0].startswith(some[a][: len(some[a]) // 2]) for a, b in zip(q.tolist(), v.tolist(), strict=True)), bool, len(q))
                q, v = q[new], v[new]
            order = np.lexsort((v, -ns[v], q))
            q, v = q[order], v[order]
            at = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1]))) if len(q) else np.zeros(0, np.int64)
            for i, n_near in zip(at.tolist(), np.diff(np.append(at, len(q))).tolist(), strict=True):
                out["word"].append(some[q[i]])
                out["n_near"].append(n_near)
                out["best_n"].append(int(ns[v[i]]))
                out["best"].append(listed[v[i]][0])
    return pa.table(out, pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())]))


def groups(words: DataFrame) -> DataFrame:
    """(side, part, role, word, n): the groups in which words are indexed (role 0), searched for (1), or both (2)."""
    both = words.select("word", "n", F.explode(F.array(F.lit(0), F.lit(1))).alias("side"))
    keyed = both.withColumn("key", F.when(F.col("side") == 0, F.substring("word", 1, KEY)).otherwise(F.substring("word", -KEY, KEY)))
    sizes = stored(keyed.groupBy("side", "key").agg(F.sum(F.length("word") + 1).alias("size")))
    chunks = F.ceil(F.col("size") / CHUNK).cast("int")
    parts = sizes.agg(F.greatest(F.ceil(F.sum("size") / CHUNK), F.lit(1)).alias("parts"))
    large = stored(sizes.where(F.col("size") > CHUNK).select("side", "key", chunks.alias("chunks")))
    with_size = keyed.join(small(large), ["side", "key"], "left").crossJoin(F.broadcast(parts))
    few = with_size.where("chunks is null").select("side", F.xxhash64(F.lit(""), F.pmod(F.xxhash64("key"), "parts")).alias("part"), F.lit(2).alias("role"), "word", "n")
    own, every = F.pmod(F.xxhash64("word"), "chunks"), F.explode(F.expr("sequence(0, chunks - 1)"))
    many = with_size.where("chunks is not null").withColumn("own", own.cast("int")).withColumn("other", every)
    listed = many.select("side", F.xxhash64("key", "own", "other").alias("part"), F.lit(0).alias("role"), "word", "n")
    asked = many.select("side", F.xxhash64("key", "other", "own").alias("part"), F.lit(1).alias("role"), "word", "n")
    return few.unionByName(listed).unionByName(asked)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best n, best word) of the words that have a near word."""
    found = groups(words).groupBy("side", "part").applyInArrow(_answers, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best"))


def forms(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of stored rows (word, n)."""
    is_form = F.col("best_n") >= FORM * F.col("n")
    joined = words.join(near_words(words), "word", "left")
    found = stored(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")))
    roots = stored(found.where("form is not null").select("word", F.col("form").alias("root")))
    while True:  # each round doubles the steps that are followed; a form is ten times as frequent, so that few rounds do
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = stored(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        moved = new.where("moved").limit(1).count()
        if not moved:
            break
        dropped(roots)
        roots = new
    return found.join(roots.select("word", "root"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forms(stored(vocabulary(table(spark, sf_dir, "documents"))))


ORACLE_SQL = rf"""
with recursive table8 as (
  select list(c order by i) t from (
    select i, list_reduce([i::bigint] || range(8)::bigint[], lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) c from range(256) r(i)
  )
),
runs as materialized (
  select doc_id, run, count(*) n from (
    select coalesce(doc_id::varchar, '') doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) run from documents
  ) where length(run) >= {SHORTEST} group by doc_id, run
),
hashed as (
  select run, n, xor(4294967295, list_reduce([4294967295] || flatten(list_transform(string_split(doc_id || ':' || run, ''), lambda ch:
    case when unicode(ch) < 128 then [unicode(ch)::bigint] else [(192 | (unicode(ch) >> 6))::bigint, (128 | (unicode(ch) & 63))::bigint] end)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) h
  from runs, table8
),
words as materialized (
  select word, sum(n)::bigint n from (
    select case when h % {ONE_IN} = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end word, n from hashed
  ) where length(word) >= {SHORTEST} group by word having sum(n) >= {LEAST}
),
cut as materialized (
  select distinct word, n, i, substr(word, 1, i - 1) l, substr(word, i + 1) r from (select word, n, unnest(range(1, length(word) + 1))::int i from words)
),
shorter as (select distinct word, n, l || r rest from cut),
pairs as (
  select a.word, b.word other, b.n from cut a join cut b on a.l = b.l and a.r = b.r and a.word <> b.word
  union all select s.word, w.word, w.n from shorter s join words w on w.word = s.rest
  union all select w.word, s.word, s.n from shorter s join words w on w.word = s.rest
),
near as (select word, count(*) n_near, arg_min(other, (-n, other)) best, max(n) best_n from pairs group by word),
found as materialized (
  select w.word, w.n, coalesce(n_near, 0) n_near, case when best_n >= {FORM} * w.n then best end form, case when best_n >= {FORM} * w.n then best_n end form_n from words w left join near using (word)
),
follow as (
  select word, word as at, form as nxt from found
  union all select f.word, f.nxt, g.form from follow f join found g on g.word = f.nxt
)
select found.word, found.form, follow.at root, found.n, n_near::bigint n_near, form_n::bigint form_n from found join follow on follow.word = found.word and follow.nxt is null
"""
