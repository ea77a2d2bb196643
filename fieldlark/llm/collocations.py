"""Collocations: phrases mined best first, by score bounds that prefix counts give, until each language's top is settled.

A phrase of two or three words scores floor(SCALE * a * a / (l * r)) at its lowest-scoring cut: a is its count, l and r are the
counts of the parts. Phrases grow by a word. All phrases of one and two words are counted first; a longer phrase w1 w2 w3
can't score above SCALE * f(w1 w2) / f(w1), since a is at most f(w1 w2) and at most the count of the rest. So the frontier is
the phrases of two words, each with this bound. A language's goal is a score: the nodes whose bound reaches it are expanded, and the
phrases of three words that hold a pair which itself reaches the goal are counted too, as they decide whether the pair is dropped. When
TOP phrases that reach the goal survive, nothing below it can enter, ties included, and the language is settled; else its goal
falls to the score of a place in the ranking of pairs that is WIDER times as deep. The last goal is 0, which expands everything.

Nulls: a null text is an empty one, a null lang is `und`. Repeated rows count as often as they occur. Empty tables and texts
give no rows. Texts are read in parts of PIECE bytes, cut between their pieces, or between words in longer pieces; counts are summed in
tasks (TOGETHER words at a time), then by phrase, so that no language or phrase is gathered in one task; rankings keep TOP rows of each
language and task before they shuffle. Products are exact decimals of 38 digits: counts up to some 10**16. Other columns
of `docs` are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._spark import dropped, small, stored, table

#: Report length, least count, scale of scores, and the share (in hundredths) of a phrase's count at which a longer one replaces it.
TOP, LEAST, SCALE, REPLACES = 2000, 10, 1_000_000, 50
#: The first goal is the score of the pair at place FIRST; later ones lie WIDER times as deep.
FIRST, WIDER = 3 * TOP, 4
#: Bytes of text that are cut into words together, words that a task counts together, and rows that it passes on at once.
PIECE, TOGETHER, HELD = 1 << 18, 1 << 20, 200_000
#: Frontier nodes that are sent to the tasks at most, some 100 bytes each.
NODES = 300_000
_BREAK, _GAP = re.compile(rb"[.,;:!?\x0a-\x0d]"), re.compile(rb"[\x20\x09]")
_FOLD = bytes.maketrans(bytes(range(65, 91)) + b".,;:!?\x0b\x0c\r", bytes(range(97, 123)) + b"\n" * 9)  # A-Z to a-z, breaks to one
_LOW = (1 << 31) - 1


class _Words(dict):
    """Numbers of words, given as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _add(text: bytes, number: _Words, ids: list[int]) -> Iterator[None]:
    """Append the numbers of a text's words, and -1 after each of its pieces.

    Yields after each part of PIECE bytes or so, cut at the end of a piece, or between words where a piece is longer.
    """
    at = 0
    while at < len(text):
        end, runs_on = len(text), False
        if at + PIECE < len(text):
            cut = _BREAK.search(text, at + PIECE, at + 2 * PIECE)
            runs_on = cut is None
            cut = cut or _GAP.search(text, at + PIECE)
            end, runs_on = (cut.start(), runs_on) if cut else (end, False)
        for piece in text[at:end].translate(_FOLD).split(b"\n"):
            ids += [number[w] for w in piece.split()]  # of white space, only spaces and tabs are left
            ids.append(-1)
        if runs_on:
            ids.pop()
        at = end
        yield


def _counts(batches: Iterator[pa.RecordBatch], known: list[bytes], count: Callable[[str, np.ndarray, int], Iterator[tuple]], width: int) -> Iterator[pa.RecordBatch]:
    """(lang, w1, ..., f) of rows (lang, text), summed over some documents each.

    `count` gets a language, numbers of its words in order (-1 between pieces) and how many of the first were counted before, as context of
    those that follow; it gives columns of numbers, -1 for null, and counts. The words `known` have the first numbers.
    """
    number, held, old = _Words(zip(known, range(len(known)), strict=True)), defaultdict(list), defaultdict(int)

    def out() -> Iterator[pa.RecordBatch]:
        words = list(number)
        column = pa.array(words, pa.binary()).cast(pa.string())
        for lang, ids in held.items():
            every = np.array(ids, np.int64)
            for *columns, f in count(lang, every, old[lang]):
                for lo in range(0, len(f), HELD):
                    some = [pa.array(c[lo : lo + HELD], mask=c[lo : lo + HELD] < 0) for c in columns]
                    rows = [pa.repeat(pa.scalar(lang, pa.string()), len(some[0])), *(column.take(c) for c in some), *[pa.nulls(len(some[0]), pa.string())] * (width - len(some))]
                    yield pa.RecordBatch.from_arrays([*rows, pa.array(f[lo : lo + HELD], pa.int64())], ["lang", *(f"w{i + 1}" for i in range(width)), "f"])
            held[lang], old[lang] = every[-2:].tolist(), len(every[-2:])
        if len(number) > HELD + len(known):  # begin anew but for the words of the context
            number.clear()
            number.update(zip(known, range(len(known)), strict=True))
            for lang, ids in held.items():
                held[lang] = [number[words[i]] if i >= 0 else -1 for i in ids]

    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1), strict=True):
            key = lang.as_py()
            for _ in _add(text.as_py().encode(), number, held[key]):
                if sum(map(len, held.values())) > TOGETHER:
                    yield from out()
    yield from out()


def _distinct(*columns: np.ndarray) -> tuple:
    """The distinct rows of columns of numbers below 2**31, and their counts."""
    key = columns[0]
    if len(columns) == 3:  # two of the numbers, taken together, get a number below 2**31
        pairs, first = np.unique((columns[0] << 31) | columns[1], return_inverse=True)
        key, n = np.unique((first << 31) | columns[2], return_counts=True)
        return pairs[key >> 31] >> 31, pairs[key >> 31] & _LOW, key & _LOW, n
    if len(columns) == 2:
        key, n = np.unique((columns[0] << 31) | columns[1], return_counts=True)
        return key >> 31, key & _LOW, n
    return np.unique(key, return_counts=True)


def _read(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


def _summed(counted: DataFrame, by: list[str]) -> DataFrame:
    """Sums of counts that tasks have summed already: shuffled first, since little is left to sum before."""
    n = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return counted.repartition(n, *by).groupBy(*by).agg(F.sum("f").alias("f"))


def short_counts(read: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored counts of words (lang, w1, f), and of pairs (lang, w1, w2, f) with at least LEAST occurrences."""

    def count(lang: str, ids: np.ndarray, old: int) -> Iterator[tuple]:
        yield _distinct(ids[old:][ids[old:] >= 0])
        ends = np.arange(max(old, 1), len(ids))
        ends = ends[(ids[ends] >= 0) & (ids[ends - 1] >= 0)]
        yield _distinct(ids[ends - 1], ids[ends])

    counted = read.mapInArrow(lambda b: _counts(b, [], count, 2), "lang string, w1 string, w2 string, f long")
    counted = stored(_summed(counted, ["lang", "w1", "w2"]).where(F.col("w2").isNull() | (F.col("f") >= LEAST)))
    return counted.where("w2 is null").drop("w2"), counted.where("w2 is not null")


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(SCALE * a * a / (left * right)) in exact decimals."""
    a, left, right = (x.cast("decimal(18,0)") for x in (a, left, right))
    over = (F.lit(SCALE).cast("decimal(7,0)") * (a * a).cast("decimal(31,0)")).cast("decimal(38,0)")
    return F.call_function("div", over, (left * right).cast("decimal(36,0)")).cast("long")


def pair_scores(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """(lang, w1, w2, a, l, r, score, bound) of all pairs: the candidates of two words and the frontier in one."""
    frequent = stored(words.where(F.col("f") >= LEAST))
    of_left = small(frequent.select("lang", "w1", F.col("f").alias("l")))
    of_right = small(frequent.select("lang", F.col("w1").alias("w2"), F.col("f").alias("r")))
    joined = pairs.withColumnRenamed("f", "a").join(of_left, ["lang", "w1"]).join(of_right, ["lang", "w2"])
    bound = score(F.col("a"), F.col("a"), F.col("l"))
    return joined.select("lang", "w1", "w2", "a", "l", "r", score(F.col("a"), F.col("l"), F.col("r")).alias("score"), bound.alias("bound"))


def triple_counts(read: DataFrame, nodes: DataFrame) -> DataFrame:
    """(lang, w1, w2, w3, f) of all phrases of three words whose first pair is a node to grow, or whose last is one to judge.

    `nodes` is stored: lang, w1, w2, grows, judged. Up to NODES of them are sent to the tasks, which then
    count no other phrase; beyond that all phrases are counted, and a join keeps the wanted ones.
    """
    few, known, sent = nodes.count() <= NODES, [], None
    schema = "lang string, w1 string, w2 string, w3 string, f long"
    if few:
        rows = nodes.toArrow()
        known = sorted({w.encode() for c in ("w1", "w2") for w in rows[c].to_pylist()})
        place = {w.decode(): i for i, w in enumerate(known)}
        key = np.array([place[a] << 31 | place[b] for a, b in zip(rows["w1"].to_pylist(), rows["w2"].to_pylist(), strict=True)], np.int64)
        lang, flags = np.array(rows["lang"].to_pylist(), object), [rows[k].to_numpy() for k in ("grows", "judged")]
        sent = read.sparkSession.sparkContext.broadcast((known, {x: tuple(np.sort(key[(lang == x) & f]) for f in flags) for x in set(lang)}))

    def among(key: np.ndarray, listed: np.ndarray) -> np.ndarray:
        at = np.searchsorted(listed, key)
        return (at < len(listed)) & (listed[np.minimum(at, len(listed) - 1)] == key) if len(listed) else np.zeros(len(key), bool)

    def count(lang: str, ids: np.ndarray, old: int) -> Iterator[tuple]:
        ends = np.arange(max(old, 2), len(ids))
        ends = ends[(ids[ends] >= 0) & (ids[ends - 1] >= 0) & (ids[ends - 2] >= 0)]
        first, second, third = ids[ends - 2], ids[ends - 1], ids[ends]
        if few:
            grows, judged = sent.value[1].get(lang, (first[:0], first[:0]))
            keep = among(first << 31 | second, grows) | among(second << 31 | third, judged)
            first, second, third = first[keep], second[keep], third[keep]
        yield _distinct(first, second, third)

    counted = read.mapInArrow(lambda b: _counts(b, sent.value[0] if few else [], count, 3), schema)
    counted = _summed(counted, ["lang", "w1", "w2", "w3"]).where(F.col("f") >= LEAST)
    if few:
        return counted
    grows = nodes.where("grows").select("lang", "w1", "w2", F.lit(True).alias("_grows"))
    judged = nodes.where("judged").select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.lit(True).alias("_judged"))
    return counted.join(grows, ["lang", "w1", "w2"], "left").join(judged, ["lang", "w2", "w3"], "left").where("_grows or _judged").drop("_grows", "_judged")


def triple_scores(triples: DataFrame, words: DataFrame, pairs: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of phrases of three words: the lowest cut, ties to the shorter first part."""
    of = pairs.select("lang", F.col("w1").alias("x"), F.col("w2").alias("y"), "a")
    t = triples.withColumnRenamed("f", "a")
    t = t.join(of.toDF("lang", "w1", "w2", "f12"), ["lang", "w1", "w2"]).join(of.toDF("lang", "w2", "w3", "f23"), ["lang", "w2", "w3"])
    t = t.join(words.select("lang", "w1", F.col("f").alias("f1")), ["lang", "w1"]).join(words.select("lang", F.col("w1").alias("w3"), F.col("f").alias("f3")), ["lang", "w3"])
    one = F.struct(score(F.col("a"), F.col("f1"), F.col("f23")).alias("score"), F.lit(1).alias("k"), F.col("f1").alias("l"), F.col("f23").alias("r"))
    two = F.struct(score(F.col("a"), F.col("f12"), F.col("f3")).alias("score"), F.lit(2).alias("k"), F.col("f12").alias("l"), F.col("f3").alias("r"))
    return t.withColumn("c", F.least(one, two)).select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", "c.l", "c.r", "c.score")


def _ranked(rows: DataFrame, order: list[Column], deepest: Column) -> DataFrame:
    """Rows up to a place of each language; tasks keep no more than that of each before the shuffle where the place is a constant."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= deepest)


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first TOP surviving phrases."""
    read = _read(docs, text, lang)
    words, pairs = short_counts(read)
    scored = stored(pair_scores(words, pairs))
    langs = stored(scored.groupBy("lang").agg(F.count("*").alias("pairs")))
    settled, depth, floor = None, FIRST, stored(langs.select("lang", F.lit(None).cast("long").alias("old")))
    while True:
        # the goal of each open language: the score at this depth of its ranking of pairs, 0 beyond its end
        deep = _ranked(scored.join(small(floor), "lang", "left_semi"), [F.desc("score")], F.lit(depth)).groupBy("lang").agg(F.min("score").alias("score"))
        goal = stored(floor.join(langs, "lang").join(deep, "lang").select("lang", F.when(F.col("pairs") >= depth, F.col("score")).otherwise(0).alias("goal")))
        if not goal.limit(1).count():
            break
        known = scored.join(small(goal), "lang")
        nodes = stored(known.select("lang", "w1", "w2", (F.col("bound") >= F.col("goal")).alias("grows"), (F.col("score") >= F.col("goal")).alias("judged")).where("grows or judged"))
        triples = stored(triple_counts(read.join(small(goal.select("lang")), "lang", "left_semi"), nodes))
        longest = triples.groupBy("lang", "w1", "w2").agg(F.max("f").alias("f")).unionByName(triples.groupBy("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2")).agg(F.max("f").alias("f")))
        longest = longest.groupBy("lang", "w1", "w2").agg(F.max("f").alias("longer"))
        alive = known.where("score >= goal").join(longest, ["lang", "w1", "w2"], "left").where(f"longer is null or 100 * longer < {REPLACES} * a")
        found = alive.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", "score")
        grown = triple_scores(triples, words, scored).join(small(goal), "lang").where("score >= goal").drop("goal")
        survivors = found.unionByName(grown)
        top = stored(_ranked(survivors, [F.desc("score"), F.desc("a"), F.asc("phrase")], F.lit(TOP)))
        done = stored(goal.join(top.groupBy("lang").agg(F.count("*").alias("k")), "lang", "left").where(f"k >= {TOP} or goal = 0").select("lang"))
        new = top.join(small(done), "lang", "left_semi")
        settled = new if settled is None else settled.unionByName(new)
        rest = stored(goal.join(done, "lang", "left_anti").select("lang", F.col("goal").alias("old")))
        dropped(nodes, triples)
        floor, depth = rest, depth * WIDER
        if not rest.limit(1).count():
            break
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    if settled is None:
        settled = _ranked(scored.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", "score"), [F.desc("score")], F.lit(0))
    return settled.join(small(stored(totals)), "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE_SQL = rf"""
with pieces as materialized (
  select row_number() over () pid, lang, piece from (
    select coalesce(lang, 'und') lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) piece from documents
  )
),
w as materialized (select pid, lang, unnest(regexp_extract_all(piece, '[^\x20\x09]+')) word, generate_subscripts(regexp_extract_all(piece, '[^\x20\x09]+'), 1) pos from pieces),
phrases as (select lang, word w1, lead(word) over p w2, lead(word, 2) over p w3 from w window p as (partition by pid order by pos)),
f1 as materialized (select lang, w1, count(*) f from phrases group by all),
f2 as materialized (select lang, w1, w2, count(*) f from phrases where w2 is not null group by all),
f3 as materialized (select lang, w1, w2, w3, count(*) f from phrases where w3 is not null group by all having count(*) >= {LEAST}),
two as (
  select f2.lang, f2.w1 || ' ' || f2.w2 phrase, f2.f a, x.f l, y.f r, {SCALE}::hugeint * f2.f * f2.f // (x.f::hugeint * y.f) score
  from f2 join f1 x on x.lang = f2.lang and x.w1 = f2.w1 join f1 y on y.lang = f2.lang and y.w1 = f2.w2
  where f2.f >= {LEAST} and not exists (select 1 from f3 where f3.lang = f2.lang and 100 * f3.f >= {REPLACES} * f2.f and (f3.w1 = f2.w1 and f3.w2 = f2.w2 or f3.w2 = f2.w1 and f3.w3 = f2.w2))
),
cuts as (
  select f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3 phrase, f3.f a, x.f l1, yz.f r1, xy.f l2, z.f r2,
    {SCALE}::hugeint * f3.f * f3.f // (x.f::hugeint * yz.f) s1, {SCALE}::hugeint * f3.f * f3.f // (xy.f::hugeint * z.f) s2
  from f3 join f1 x on x.lang = f3.lang and x.w1 = f3.w1 join f1 z on z.lang = f3.lang and z.w1 = f3.w3
    join f2 xy on xy.lang = f3.lang and xy.w1 = f3.w1 and xy.w2 = f3.w2 join f2 yz on yz.lang = f3.lang and yz.w1 = f3.w2 and yz.w2 = f3.w3
),
every as (select * from two union all select lang, phrase, a, case when s1 <= s2 then l1 else l2 end, case when s1 <= s2 then r1 else r2 end, least(s1, s2) from cuts),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from every qualify rank <= {TOP})
select lang, rank, phrase, a, l, r, (select sum(f) from f1 where f1.lang = ranked.lang)::bigint n, score::bigint score from ranked
"""
