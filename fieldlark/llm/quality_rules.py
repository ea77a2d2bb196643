"""Quality rules by distribution divergence: Jensen-Shannon distances of a document's histograms from its language's.

`references` counts, for each language, the bytes of six classes and the words of the whole corpus: shares of the classes,
the COMMON most frequent words (ties to the smaller word) with their shares, and one share for all other words. A language with
fewer than MIN_REFERENCE words has no reference of its own; its documents, and those without a language, are compared with the
whole corpus. `judged` adds each document's base counts and its two distances, in bits under a root, from 0 to 1; `kept` gives
the documents that pass. A distance counts only where the document is long enough for its histogram to mean something
(MIN_CHARS word characters, MIN_WORDS words). All of it is SQL functions: nothing leaves the JVM, documents are never shuffled
or exploded for their verdict, and only the references (a row for each language) are joined to them.

Nulls: a null text is an empty one (no words: fails the base rules), a null id stays null. Repeated rows are judged alike, each
row for itself, and count as often as they occur in the references. An empty table gives no rows; without any word there is no
reference, and distances are null, which fails nothing. A language with fewer words than COMMON lists those it has. Texts are read whole; windows of words are compared by 64-bit hashes
within one document. Columns of `docs` may have any name: they travel in a struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._spark import hot_join, small, stored, table

#: Words `[^\x20\x09-\x0D]+` are what these separators leave.
SEPARATORS = r"[\x20\x09-\x0D]+"
#: Base rules: fewest words, and the share (in hundredths) of words in repeated windows.
LEAST_WORDS, MOST_REPEATED, WINDOW = 20, 30, 8
#: Counted character classes; the others are white space, the bytes of a character beyond its first, and all the rest, letters above all.
SYMBOLS, CAPITALS, DIGITS = "[#*$%&|<>]", "[A-Z]", "[0-9]"
#: Words of a language's histogram, and words that a language needs for a reference of its own.
COMMON, MIN_REFERENCE = 32, 5000
#: Least lengths at which a histogram is judged, and the distances from which a document is rejected.
MIN_CHARS, MIN_WORDS = 100, 50
MOST_CHAR_DISTANCE, MOST_WORD_DISTANCE = 0.29, 0.45


def let(value: Column, body) -> Column:
    """`body` of a value that is computed once, however often the body mentions it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SEPARATORS), "")


def repeated_words(w: Column) -> Column:
    """Words that lie in a window of WINDOW words which the text has twice or more, first occurrences included."""

    def covered(s: Column) -> Column:
        twice = F.filter(s, lambda x, j: F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False)))
        return let(
            F.array_sort(F.transform(twice, lambda x: x["i"])),
            lambda at: F.aggregate(F.transform(at, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - p, F.lit(WINDOW)))), F.lit(0).cast("long"), lambda a, x: a + x),
        )

    def counted(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), let(pairs, covered)).otherwise(F.lit(0).cast("long"))

    hashes = F.transform(w, lambda x: F.xxhash64(x))
    windows = let(hashes, lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(WINDOW)))))
    return F.when(F.size(w) > WINDOW, let(windows, counted)).otherwise(F.lit(0).cast("long"))


def duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def count_of(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, x: a + x)


def class_counts(chars: Column, size: Column, word_chars: Column, capitals: Column, digits: Column, symbols: Column) -> Column:
    """Bytes of a text of `chars` characters and `size` bytes: white space, capitals, digits, symbols, bytes beyond a character's first, the rest."""
    rest = word_chars - capitals - digits - symbols
    return F.array(chars - word_chars, capitals, digits, symbols, size - chars, rest)


def common_counts(w: Column, listed: Column) -> Column:
    """How often each of the listed words occurs, and how many other words there are.

    Words become places in the list, which are sorted; the first place of each run gives its count.
    """
    short = let(F.array_max(F.transform(listed, lambda x: F.length(x))), lambda longest: F.filter(w, lambda x: F.length(x) <= longest))
    places = F.filter(F.transform(short, lambda x: F.array_position(listed, x)), lambda x: x > 0)

    def counts(at: Column) -> Column:
        starts = F.filter(F.transform(at, lambda x, i: F.struct(x.alias("place"), i.alias("i"))), lambda x: F.coalesce(F.get(at, x["i"] - 1) != x["place"], F.lit(True)))
        runs = let(starts, lambda s: F.transform(s, lambda x, j: F.struct(x["place"].alias("place"), (F.coalesce(F.get(s, j + 1)["i"], F.size(at)) - x["i"]).alias("n"))))
        known = let(F.map_from_entries(runs), lambda m: F.transform(listed, lambda _, i: F.coalesce(F.try_element_at(m, (i + 1).cast("long")), F.lit(0)).cast("long")))
        return F.concat(known, F.array((F.size(w) - F.size(at)).cast("long")))

    return let(F.sort_array(places), counts)


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance, to base 2, of two arrays of shares of the same length."""

    def half(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(0.0)

    both = F.aggregate(F.zip_with(p, q, lambda x, y: half(x, y) + half(y, x)), F.lit(0.0), lambda a, x: a + x)
    return F.sqrt(F.least(F.greatest(both / 2, F.lit(0.0)), F.lit(1.0)))


def shares(counts: Column, total: Column) -> Column:
    return F.transform(counts, lambda x: x / total)


def _read(docs: DataFrame, text: str, lang: str) -> DataFrame:
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.struct(*docs.columns).alias("_doc"), F.col(lang).cast("string").alias("_lang"), body.alias("_text")).select("*", words(F.col("_text")).alias("_words"))


def references(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, words, word_shares, class_shares) for each language with enough words, and for the corpus, whose lang is null.

    `word_shares` ends with the share of all other words. Stored; one row for each language.
    """
    read, body = _read(docs, text, lang), F.col("_text")
    counted = stored(read.select("_lang", F.explode("_words").alias("word")).groupBy("_lang", "word").agg(F.count("*").alias("f")))
    sums = {"chars": F.length(body), "size": F.octet_length(body), "capitals": count_of(body, CAPITALS), "digits": count_of(body, DIGITS), "symbols": count_of(body, SYMBOLS)}
    chars = read.groupBy("_lang").agg(*(F.sum(x).alias(k) for k, x in sums.items()))
    of_words = counted.groupBy(F.col("_lang").alias("_l")).agg(F.sum("f").alias("n"), F.sum(F.col("f") * F.length("word")).alias("word_chars"))
    totals = stored(chars.join(of_words, F.col("_lang").eqNullSafe(F.col("_l"))).drop("_l"))
    of_all = totals.agg(*(F.sum(c).alias(c) for c in totals.columns[1:])).where("n > 0").select(F.lit(None).cast("string").alias("_lang"), "*")
    every = totals.where((F.col("n") >= MIN_REFERENCE) & F.col("_lang").isNotNull()).unionByName(of_all)
    top = counted.where(F.col("_lang").isNotNull()).withColumn("r", F.row_number().over(Window.partitionBy("_lang").orderBy(F.desc("f"), "word"))).where(F.col("r") <= COMMON)
    top_all = counted.groupBy("word").agg(F.sum("f").alias("f")).orderBy(F.desc("f"), "word").limit(COMMON)
    listed = F.array_sort(F.collect_list(F.struct((-F.col("f")).alias("f"), "word"))).alias("top")
    tops = top.groupBy("_lang").agg(listed).unionByName(top_all.groupBy(F.lit(None).cast("string").alias("_lang")).agg(listed))
    joined = every.join(tops.withColumnRenamed("_lang", "_l"), F.col("_lang").eqNullSafe(F.col("_l")))
    rest = let(F.transform("top", lambda x: -x["f"]), lambda x: F.concat(x, F.array(F.col("n") - total(x))))
    classes = class_counts(*(F.col(c) for c in ("chars", "size", "word_chars", "capitals", "digits", "symbols")))
    return stored(joined.select(F.col("_lang").alias("lang"), F.transform("top", lambda x: x["word"]).alias("words"), shares(rest, F.col("n")).alias("word_shares"), shares(classes, F.col("size")).alias("class_shares")))


def judged(docs: DataFrame, refs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """`doc` (a struct of the columns of docs), the base counts, both distances and the verdicts."""
    read = _read(docs, text, lang)
    own = refs.where("lang is not null").select(F.col("lang").alias("_lang"), F.struct("words", "word_shares", "class_shares").alias("_own"))
    every = refs.where("lang is null").agg(F.first(F.struct("words", "word_shares", "class_shares"), ignorenulls=True).alias("_every"))
    guarded = small(own)
    joined = read.join(guarded, "_lang", "left") if guarded is not own else hot_join(read, own, "_lang", "left")
    joined = joined.crossJoin(F.broadcast(every)).withColumn("_ref", F.coalesce("_own", "_every"))
    w, body = F.col("_words"), F.col("_text")
    counted = joined.select(
        "_doc", "_ref", "_text", "_words", F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        count_of(body, SYMBOLS).alias("n_symbols"), duplicate_lines(body).alias("n_dup_lines"), repeated_words(w).alias("n_repeat_words"),
    )
    classes = class_counts(F.length(body), F.octet_length(body), F.col("word_chars"), count_of(body, CAPITALS), count_of(body, DIGITS), F.col("n_symbols"))
    measured = counted.select(
        "_doc", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.when(F.col("word_chars") >= MIN_CHARS, distance(shares(classes, F.octet_length(body)), F.col("_ref.class_shares"))).alias("char_distance"),
        F.when(F.col("n_words") >= MIN_WORDS, distance(shares(common_counts(w, F.col("_ref.words")), F.col("n_words")), F.col("_ref.word_shares"))).alias("word_distance"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    near = (F.coalesce("char_distance", F.lit(0.0)) <= MOST_CHAR_DISTANCE) & (F.coalesce("word_distance", F.lit(0.0)) <= MOST_WORD_DISTANCE)
    return measured.withColumnRenamed("_doc", "doc").withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & near)


def kept(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents that pass all rules, with their columns."""
    return judged(docs, references(docs, text, lang), text, lang).where("kept").select("doc.*")


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = judged(docs, references(docs))
    distances = (F.round(c, 6).alias(c) for c in ("char_distance", "word_distance"))
    return found.select("doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", *distances)


ORACLE_SQL = rf"""
with docs as materialized (select row_number() over () rid, doc_id, coalesce(text, '') t, lang from documents),
w as materialized (
  select rid, lang, unnest(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) word, generate_subscripts(regexp_extract_all(t, '[^\x20\x09-\x0D]+'), 1) pos from docs
),
windows as (
  select rid, pos, concat_ws(' ', word{"".join(f", lead(word, {k}) over ps" for k in range(1, WINDOW))}) win, lead(word, {WINDOW - 1}) over ps last
  from w window ps as (partition by rid order by pos)
),
twice as (select rid, pos from (select rid, pos, count(*) over (partition by rid, win) c from windows where last is not null) where c > 1),
covered as (select rid, sum(least({WINDOW}, coalesce(nxt - pos, {WINDOW}))) n from (select rid, pos, lead(pos) over (partition by rid order by pos) nxt from twice) group by rid),
lines as (select rid, count(*) - count(distinct line) n from (select rid, unnest(string_split(t, chr(10))) line from docs) where regexp_matches(line, '[^\x20\x09-\x0D]') group by rid),
sizes as (select rid, count(*) n, sum(length(word)) c from w group by rid),
base as materialized (
  select d.rid, d.doc_id, d.lang, length(t) chars, octet_length(encode(t)) size, coalesce(s.n, 0) n_words, coalesce(s.c, 0) word_chars,
    length(regexp_replace(t, '[^A-Z]', '', 'g')) capitals, length(regexp_replace(t, '[^0-9]', '', 'g')) digits,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) symbols, coalesce(l.n, 0) dup_lines, coalesce(c.n, 0) repeated
  from docs d left join sizes s using (rid) left join lines l using (rid) left join covered c using (rid)
),
keys as (
  select lang from base where lang is not null group by lang having sum(n_words) >= {MIN_REFERENCE}
  union all select null where exists (select 1 from w)
),
counts as (select k.lang, word, count(*) f from keys k join w on k.lang is null or w.lang = k.lang group by k.lang, word),
tops as (select lang, word, f from counts qualify row_number() over (partition by lang order by f desc, word) <= {COMMON}),
totals as (
  select k.lang, sum(n_words) n, sum(size) size, [sum(chars) - sum(word_chars), sum(capitals), sum(digits), sum(symbols), sum(size) - sum(chars), sum(word_chars) - sum(capitals) - sum(digits) - sum(symbols)] classes
  from keys k join base b on k.lang is null or b.lang = k.lang group by k.lang
),
named as materialized (select b.*, case when b.lang in (select lang from keys where lang is not null) then b.lang end as ref from base b),
ranked as (
  select n.rid, sum(case when x.p > 0 then x.p * log2(2 * x.p / (x.p + x.q)) else 0 end + case when x.q > 0 then x.q * log2(2 * x.q / (x.p + x.q)) else 0 end) / 2 j
  from named n join (
    select rid, coalesce(c, 0)::double / n_words p, f::double / n q from named join totals t on t.lang is not distinct from ref join tops o on o.lang is not distinct from ref
      left join (select rid, word, count(*) c from w group by rid, word) using (rid, word)
    union all
    select rid, (n_words - (select count(*) from w join tops o using (word) where w.rid = named.rid and o.lang is not distinct from ref))::double / n_words p,
      (n - (select sum(f) from tops o where o.lang is not distinct from ref))::double / n q
    from named join totals t on t.lang is not distinct from ref
  ) x using (rid) group by n.rid
),
classed as (
  select rid, sum(case when p > 0 then p * log2(2 * p / (p + q)) else 0 end + case when q > 0 then q * log2(2 * q / (p + q)) else 0 end) / 2 j
  from (
    select rid, unnest([chars - word_chars, capitals, digits, symbols, b.size - chars, word_chars - capitals - digits - symbols])::double / b.size p, unnest(classes)::double / t.size q
    from named b join totals t on t.lang is not distinct from ref where b.size > 0
  ) group by rid
),
judged as (
  select b.*, n_words < {LEAST_WORDS} or 100 * repeated > {MOST_REPEATED} * n_words base_failed,
    case when word_chars >= {MIN_CHARS} then sqrt(least(greatest(c.j, 0), 1)) end char_distance, case when n_words >= {MIN_WORDS} then sqrt(least(greatest(r.j, 0), 1)) end word_distance
  from base b left join classed c using (rid) left join ranked r using (rid)
)
select doc_id, n_words::bigint n_words, word_chars::bigint word_chars, symbols::bigint n_symbols, dup_lines::bigint n_dup_lines, repeated::bigint n_repeat_words, base_failed,
  not base_failed and coalesce(char_distance, 0) <= {MOST_CHAR_DISTANCE} and coalesce(word_distance, 0) <= {MOST_WORD_DISTANCE} kept,
  round(char_distance, 6) char_distance, round(word_distance, 6) word_distance
from judged
"""
