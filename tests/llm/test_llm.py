"""Training-data operators against brute force, exact round trips and held-out accuracy, and on awkward rows."""

import hashlib
import random
import re
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from oracle import SF, compare  # noqa: E402

import corpus_pipeline  # noqa: E402
from fieldlark.llm import decontaminate, extract, jaccard_join, knn, language, licenses, mixing, quality, queries, toxicity, warc  # noqa: E402
from fieldlark.llm._spark import components  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n int, d double, root long, score double, row long, mix_n int"


def documents(spark, rows):
    """Rows of (doc_id, text) with nulls elsewhere and columns whose names operators use themselves."""
    return spark.createDataFrame([(i, t, None if i is None or i % 5 == 0 else "en", None, None, 1, 0.5, 7, 0.1, 3, 2) for i, t in rows], DOCS)


AWKWARD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two three four"), (6, "!!! ??? 123"), (7, "x" * 50_000), (8, "word " * 20_000), (8, "word " * 20_000), (9, "one two three four five six"), (10, "ONE two three four five six"), (None, "one two three four five six")]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    compare(spark, queries.QUERIES[name], queries.ORACLE_SQL[name])


# ------------------------------------------------------------- similarity join


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_components(rows):
    sets, root = {i: shingle_set(t) for i, t in rows if i is not None}, {}
    for i in sets:
        root[i] = i

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                shared = len(sets[a] & sets[b])
                if 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(seed, n):
    """Families of texts with edits from none to many, so that pairs fall on both sides of the threshold."""
    r = random.Random(seed)
    word = lambda: r.choice("abcdefghij") + str(r.randrange(400))
    common, out = " ".join(word() for _ in range(12)), []
    for _ in range(4):
        base = [word() for _ in range(120)]
        for _ in range(n // 4):
            t = list(base)
            for _ in range(r.choice((0, 1, 2, 3, 4, 5, 6, 8))):
                t[r.randrange(len(t))] = word()
            out.append((len(out), " ".join(t) + (" " + common if r.random() < 0.3 else "")))
    return out


@pytest.mark.parametrize("block", [256, 3])
def test_jaccard_components(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rows = near_copies(5, 160) + [(1000 + i, t) for i, t in AWKWARD if i is not None]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(documents(spark, rows).repartition(3)).collect()}
    assert got == brute_components(rows)


def test_open_clusters_are_resolved(spark):
    """Members of two clusters that only meet away from their leaders."""
    members = near_copies(9, 80)
    docs = documents(spark, members).select(F.col("doc_id").alias("id"), "text")
    rows = spark.createDataFrame([(0, 0, 0.0)] + [(i, 0 if i < 40 else 40, 0.15) for i, _ in members[1:]], "id long, leader long, d double")
    unsure = spark.createDataFrame([(0, 40, 0.3, 0.2, 0.2)], "a long, b long, d double, r1 double, r2 double")
    sets = {i: shingle_set(t) for i, t in members}
    link = lambda a, b: 100 * (s := len(sets[a] & sets[b])) >= 80 * (len(sets[a]) + len(sets[b]) - s)
    want = any(link(a, b) for a in range(40) for b in range(40, 80))
    found = jaccard_join._opened(docs, rows, unsure, 5, 0.8).collect()
    assert all(link(r["a"], r["b"]) for r in found) and bool(found) == want


def test_jaccard_of_nothing(spark):
    assert jaccard_join.jaccard_components(documents(spark, [])).count() == 0


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 30)] + [(100, 101), (5, 5)], "a long, b long")
    assert {r["node"]: r["root"] for r in components(edges).collect()} == {**{i: 1 for i in range(2, 31)}, 101: 100}


# ------------------------------------------------------------- archives and pages


def test_warc_round_trip(spark, tmp_path):
    rows = [(3, "http://a/x?y#z", "same\r\n\r\nWARC/1.1 é"), (1, "http://a/b", "same\r\n\r\nWARC/1.1 é"), (2, None, None), (None, "http://n", "same\r\n\r\nWARC/1.1 é"), (4, "", ""), (5, "u", "long " * 100_000), (5, "u", "long " * 100_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    path = str(tmp_path / "w")
    warc.write_warc(pages, path)
    full = warc.assemble(warc.read_warc(spark, path)).collect()
    assert len(full) == len(rows) and all(r["request"] and r["metadata"] for r in full)
    page = lambda r: (lambda f: int(f["page-id"]) if "page-id" in f else None)(dict(r["metadata"]["fields"]))
    texts = sorted((str(page(r)), ((r["original"] or r["response"])["payload"] or b"").decode()) for r in full)
    assert texts == sorted((str(i), t or "") for i, _, t in rows)
    assert sorted(page(r) or 0 for r in full if r["response"]["record_type"] == "response") == [1, 2, 5]
    assert full[0]["response"]["payload_digest"] and all((r["original"] or r["response"])["payload_sha1"] == r["response"]["payload_digest"] for r in full)
    assert warc.captures(pages.limit(0), "d").count() == 0


def test_base32(spark):
    import base64

    got = spark.range(1).select(warc.base32(F.sha1(F.lit("abc").cast("binary"))).alias("x")).first()["x"]
    assert got == base64.b32encode(hashlib.sha1(b"abc").digest()).decode()


PAGE = """<html><head><title>t</title><script>var a="</p><p>no";</script></head><body><header><h1>Site</h1></header><nav><ul><li>Home</ul></nav>{0}<div class="site-notice">We use cookies</div>
<div class="{1}"><h2>Head {2}</h2><p>First{2} &amp; <b>bold</b><br>line &#233;<p>Second{2}<ul><li>one{2}<li>two{2}</ul><table><tr><td>x{2}</td><td>y</td></tr></table></div>
<aside>Side</aside><form>Mail <input></form><section id="comments"><p>Reader says</p></section><footer>Foot</footer></body></html>"""


def test_main_text(spark):
    rows = [(i, f"http://h{i % 2}.example/p{i}", PAGE.format("<div>Welcome to us</div>", "story", i)) for i in range(10)]
    rows += [(20, None, None), (21, "x", ""), (22, "http://h0.example/z", "<p>cut <b>off"), (23, "http://q/", "<article><p>A</p><div class=comments>c</div></article><div>B</div>")]
    got = {r["page_id"]: r["text"] for r in extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(10):
        assert got[i] == f"Head {i}\n\nFirst{i} & bold line é\n\nSecond{i}\n\none{i}\n\ntwo{i}\n\nx{i} y"
    assert (got[20], got[21], got[22], got[23]) == ("", "", "cut off", "A")
    assert extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_pages_of_the_tables(spark):
    import html

    source = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in queries.QUERIES["op2_main_text"](spark, SF).collect():
        article = re.search(r"<article>(.*?)(?:</article>|$)", source[r["page_id"]], re.S).group(1)
        parts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b)))).strip() for b in re.split(r"</?(?:h1|p)>", article)]
        assert r["text"] == "\n\n".join(p for p in parts if p) and r["n_chars"] == len(r["text"])


# ------------------------------------------------------------- search


def test_top_k_of_repeated_rows(spark):
    """A repeated query row is one query; of different vectors with one id the least asks; repeated candidates stand for themselves."""
    import duckdb

    rows = [(50, [1.0, 0.0]), (50, [1.0, 0.0]), (100, [2.0, 1.0]), (100, [0.5, 1.0])] + [(i, [float(9 - i), 1.0]) for i in range(1, 7)] + [(3, [6.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    data = knn.integer_vectors(df)
    got = sorted(tuple(x) for x in knn.top_k(data, data.where("vec_id % 50 = 0")).select("query_id", "rank", "vec_id", "score").collect())
    assert [x[2] for x in got if x[0] == 50] == [1, 2, 3, 3, 4] and [x[1] for x in got if x[0] == 50] == [1, 2, 3, 4, 5]
    assert len(got) == 10
    con = duckdb.connect()
    con.register("given", df.toArrow())
    con.execute("create view embeddings as select * from given")
    assert sorted(con.sql(knn.ORACLE_SQL).fetchall()) == got


@pytest.mark.parametrize("scale", [1.0, 30.0])
def test_top_k_with_ties_and_odd_vectors(spark, monkeypatch, scale):
    monkeypatch.setattr(knn, "CHUNK", 16)
    monkeypatch.setattr(knn, "BLOCK", 2)
    r = random.Random(3)
    rows = [(i, [r.choice((-1.0, -0.25, 0.0, 0.5)) * scale for _ in range(4)]) for i in range(150)]
    rows += [(150, None), (151, [None, 1.0, 1.0, 1.0]), (152, [float("nan"), 1.0, 1.0, 1.0]), (153, [float("inf"), 0.0, 0.0, 0.0]), (200, [1.0, 2.0]), (250, []), (None, [1.0, 1.0, 1.0, 1.0])]
    data = knn.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = {(x["query_id"], x["rank"]): (x["vec_id"], x["score"]) for x in knn.top_k(data, data.where("vec_id % 50 = 0")).collect()}
    ints = {x["vec_id"]: x["v"] for x in data.collect()}
    want = {}
    for q in (i for i in ints if i % 50 == 0):
        best = sorted((-sum(a * b for a, b in zip(ints[q], v, strict=True)), i) for i, v in ints.items() if i != q and len(v) == len(ints[q]))[:5]
        want |= {(q, k + 1): (i, -s) for k, (s, i) in enumerate(best)}
    assert got == want
    assert knn.top_k(data.limit(0), data.limit(0)).count() == 0


# ------------------------------------------------------------- decontamination


def test_contained_items(spark):
    r = random.Random(1)
    words = lambda n: [f"w{r.randrange(10_000)}" for _ in range(n)]
    items = [(i, " ".join(words(r.choice((5, 9, 20, 60))))) for i in range(12)] + [(50, "Only, three words"), (51, None), (52, "..."), (None, "a b c d e f")]
    texts = [(i, " ".join(words(300)) + " " + items[i % 12][1].upper() + ". " + " ".join(words(200))) for i in range(24)]
    changed = items[3][1].split()
    changed[len(changed) // 2] = "zzz"
    texts += [(30, " ".join(words(50) + changed)), (31, "x only three WORDS y"), *((100 + (i or 0), t) for i, t in AWKWARD)]

    def grams(t, k=5):
        w = [x for x in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t.lower())]
        return w, {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}

    want = set()
    for i, t in texts:
        for j, x in items:
            if j is None or not x or not grams(x)[0]:
                continue
            k = min(5, len(grams(x)[0]))
            q = grams(x, k)[1]
            if 10 * len(q & grams(t or "", k)[1]) >= 8 * len(q):
                want.add((i, j))
    docs = documents(spark, texts)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(x["doc_id"], x["item_id"]) for x in decontaminate.contained_items(docs, benchmark).collect()}
    assert got == want and (31, 50) in got
    assert decontaminate.contained_items(docs, benchmark.limit(0)).count() == 0


def test_large_benchmarks_take_several_passes(spark, monkeypatch):
    base = sorted(map(tuple, queries.QUERIES["op10_contained_items"](spark, SF).collect()))
    monkeypatch.setattr(decontaminate, "MOST_SHINGLES", 200)
    assert sorted(map(tuple, queries.QUERIES["op10_contained_items"](spark, SF).collect())) == base


# ------------------------------------------------------------- classifiers


@pytest.mark.parametrize("name, label", [("op9_quality_discriminant", "quality"), ("op7_toxicity_svm", "toxic")])
def test_held_out_labels(spark, name, label):
    folder = SF.replace("sf0.001", "sf0.01")
    rows = queries.QUERIES[name](spark, folder).where("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    n, right = rows.count(), rows.where(F.col("predicted") == F.col(label)).count()
    assert right >= 0.85 * n and n > 20


def test_language_held_out(spark):
    folder = SF.replace("sf0.001", "sf0.01")
    rows = queries.QUERIES["op5_language_id"](spark, folder).where("held_out").join(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id")
    assert rows.where("lang = lang_pred").count() >= 0.98 * rows.count()


def test_classifiers_on_awkward_rows(spark):
    docs = documents(spark, AWKWARD)
    names, matrix = language.train(docs)
    lang = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(docs, names, matrix).collect()}
    assert len(lang) == 11 and lang[1] == lang[2] == lang[6] == ("und", 0.0) and lang[4][0] == "en"
    assert {r["lang_pred"] for r in language.predict(docs, *language.train(docs.limit(0))).collect()} == {"und"}
    x = quality.document_statistics(docs)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(3, 11)] + [(None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    for y in (labels, labels.limit(0), labels.where("quality = 1")):
        scores = [r["score"] for r in quality.scored(x, quality.fit(x, y, "quality")).collect()]
        assert len(scores) == 12 and all(0 <= s <= 1 for s in scores)
    plain = docs.select("doc_id", "text")
    for y in (labels, labels.limit(0)):
        scores = [r["score"] for r in toxicity.scored(plain, toxicity.fit(plain, y)).collect()]
        assert len(scores) == 12 and all(0 <= s <= 1 for s in scores)


def test_subsequence_kernel_by_definition():
    import itertools

    import numpy as np

    def slow(s, t):
        def weights(u):
            out = {}
            for at in itertools.combinations(range(len(u)), toxicity.P):
                k = "".join(u[i] for i in at)
                out[k] = out.get(k, 0) + toxicity.DECAY ** (at[-1] - at[0] + 1)
            return out

        a, b = weights(s), weights(t)
        return sum(v * b.get(k, 0) for k, v in a.items())

    for s, t in (("idiot", "i.d.i.o.t"), ("banana", "ananas"), ("abcd", "abcd"), ("abc", "xyzw")):
        row = np.zeros((1, 12), np.uint8)
        row[0, : len(s)] = list(s.encode())
        assert abs(toxicity.kernel(row, np.frombuffer(t.encode(), np.uint8))[0] - slow(s, t)) < 1e-12


def test_filter_keeps_every_value_of_the_kernel():
    """Gapped and inserted-character words against the kernel of all words with all landmarks."""
    import numpy as np

    r = random.Random(2)
    strings = ["scum", "noob", "aaaa", "\x02idiot", "pathetic", "réêen", *("".join(r.choice("abcdeé") for _ in range(9)) for _ in range(12))]
    landmarks = toxicity.Landmarks(strings)
    words = ["s*c**u*m", "s**c**u**m", "noob", "n.o.o.b", "\x02idiot", "\x02i-d-i-o-t", "p..a.t.h.e.t.i.c"]
    words += ["".join(c + "*" * r.choice((0, 0, 1, 2)) for c in r.choice(strings)) for _ in range(300)] + ["".join(r.choice("abcdeé*") for _ in range(r.randrange(1, 16))) for _ in range(300)]
    rows = np.zeros((len(words), toxicity.WIDTH), np.uint8)
    for i, w in enumerate(words):
        b = w.encode()[: toxicity.WIDTH]
        rows[i, : len(b)] = list(b)
    full = np.stack([np.minimum(1, toxicity.kernel(rows, z) / own) for z, own in zip(landmarks.z, landmarks.own, strict=True)], axis=1)
    assert np.allclose(landmarks.values(rows), np.where(full < toxicity.FAINT, 0, full**2), atol=1e-12)
    assert landmarks.values(rows)[0, 0] > 0 and landmarks.values(rows)[2, 1] == 1


def test_reader_with_little_memory(monkeypatch):
    """Forgetting words changes no value, and leaves no more rows than those of the words known."""
    import pyarrow as pa

    r = random.Random(4)
    pool = ["idiot", "id.iot", "scum", "s*cum", "noob", *(f"w{i}" for i in range(30))]
    texts = pa.array([" ".join(r.choice(pool) for _ in range(12)) for _ in range(60)])
    monkeypatch.setattr(toxicity.T, "CHUNK", 100)
    landmarks = toxicity.Landmarks(["idiot", "scum", "noob"])
    want = [(i, v.tolist()) for i, v in toxicity.Reader(landmarks).sentences(texts)]
    monkeypatch.setattr(toxicity, "REMEMBER", 14)
    reader = toxicity.Reader(landmarks)
    assert [(i, v.tolist()) for i, v in reader.sentences(texts)] == want and want
    assert len(reader.rows) <= len(reader.known) + 1


def test_licences(spark):
    lines = [(1, "Released under the MIT License."), (2, "some text\nLicensed under CC BY-NC 4.0.\nmore"), (3, "This work is licensed under the GNU General Public License, version 3."), (4, "Licensed under the Apache License, Version 2.0."), *((10 + (i or 0), t) for i, t in AWKWARD)]
    docs = documents(spark, lines)
    model = licenses.train(spark.read.parquet(f"{SF}/documents.parquet"))
    got = {(r["doc_id"], r["paragraph"], r["family"]) for r in licenses.scan(docs, model).where("confirmed").collect()}
    assert got == {(1, 0, "mit"), (2, 1, "cc-by-nc"), (3, 0, "gpl"), (4, 0, "apache-2.0")}


def test_frequent_notices(spark):
    """A third of the documents hold a short notice; and prose has the words of it, but not the phrase."""
    r = random.Random(6)
    prose = lambda n: " ".join(r.choice("the of seat river sun stone walk green house".split()) + " " + r.choice("rights reserved all released under mit license free".split()) for _ in range(n))
    rows = [(i, "\n".join([prose(12), prose(30), *(["All rights reserved."] if i % 3 == 0 else []), prose(20), *(["Released under the MIT License."] if i == 7 else [])])) for i in range(300)]
    docs = documents(spark, rows)
    got = {(x["doc_id"], x["paragraph"], x["family"]) for x in licenses.scan(docs, licenses.train(docs)).where("confirmed").collect()}
    assert got == {(7, 3, "mit")} | {(i, 2, "proprietary") for i in range(0, 300, 3)}


# ------------------------------------------------------------- mixing and the pipeline


@pytest.mark.parametrize("given", [None, {"source": {"a": 3.0, "b": 1.0, "gone": 2.0}, "topic": {"t": 1.0, "u": 1.0}}])
def test_raking_as_tables_is_the_same(spark, monkeypatch, given):
    cells = spark.createDataFrame([("a", "x", "t", 10), ("a", "y", "t", 30), ("b", "x", "u", 20), ("b", "y", "t", 5), ("c", "y", "u", 900)], "source string, lang string, topic string, tokens long")
    key = lambda df: {(r["source"], r["lang"], r["topic"]): round(r["weight"], 5) for r in df.collect()}
    monkeypatch.setattr(mixing, "TOLERANCE_BEYOND", 1e-7)
    monkeypatch.setattr(mixing, "MOST_ROUNDS", 12)
    monkeypatch.setattr(mixing, "ROUNDS_BEYOND", 12)
    assert key(mixing.rake_tables(cells, given, 0.6)) == key(mixing.rake_bounded(cells, mixing._targets(cells, given), 0.6))


def test_raking_of_many_sources(spark, monkeypatch):
    """100 000 sources, one with a third of all tokens: no value comes to the driver, and every source meets its goal."""
    monkeypatch.setattr(mixing, "ROUNDS_BEYOND", 4)
    n = 100_000
    source = F.concat(F.lit("http://s/"), (F.col("id") % n).cast("string"))
    cells = spark.range(2 * n).select(source.alias("source"), F.when(F.col("id") < n, "en").otherwise("de").alias("lang"), F.when(F.col("id") % 3 == 0, "t").otherwise("u").alias("topic"), F.when(F.col("id") == 7, 20_000_000).otherwise(F.col("id") % 200 + 1).alias("tokens"))
    raked = mixing.stored(mixing.rake_tables(cells, None, 0.5))
    assert raked.count() == 2 * n and raked.where("weight < 0 or weight > 1 or isnan(weight)").count() == 0
    kept = raked.agg(F.sum(F.col("weight") * F.col("tokens")).alias("w"), F.sum("tokens").alias("t")).first()
    assert abs(kept["w"] / kept["t"] - 0.5) < 0.05


def test_final_probabilities_meet_the_marginals(spark):
    """Skewed cells, of which raking without the bound would take more than all; and a value with too few tokens."""
    sizes = {("a", "x", "t"): 900, ("a", "y", "t"): 60, ("a", "x", "u"): 50, ("b", "x", "t"): 40, ("b", "y", "u"): 300, ("b", "y", "t"): 20}
    docs = spark.createDataFrame([(i, "w" + " w" * (9 if k[2] == "t" else 59), k[1], k[0]) for k, n in sizes.items() for i in range(n)], "doc_id long, text string, lang string, source string")
    for b in ("a", "c"):
        docs = docs if b != "c" else docs.unionByName(docs.limit(1).withColumn("source", F.lit("c")))
        goals = {"source": {"a": 0.5, "b": 0.5, "c": 0.2}, "lang": {"x": 0.5, "y": 0.5}}
        named = mixing._with_cells(docs, "text", "source", "lang", {c: f"mix_{c}" for c in ("n", *mixing.DIMENSIONS)})
        cells = named.groupBy(*(F.col(f"mix_{d}").alias(d) for d in mixing.DIMENSIONS)).agg(F.sum("mix_n").alias("tokens"))
        want = mixing._targets(cells, goals)
        raked = mixing.rake_bounded(cells, want, 0.5).collect()
        whole = sum(r["tokens"] for r in raked)
        kept = sum(r["tokens"] * r["weight"] for r in raked)
        assert all(0 <= r["weight"] <= 1 for r in raked) and abs(kept - 0.5 * whole) < 1e-4 * whole
        for d in mixing.DIMENSIONS:
            for v, share in want[d].items():
                held = sum(r["tokens"] * r["weight"] for r in raked if r[d] == v)
                if b == "c" and d == "source":
                    assert abs(held - (10 if v == "c" else (kept - 10) / 2)) < 1e-4 * kept
                else:
                    assert abs(held / kept - share) < 1e-4


def test_mixing_awkward_rows(spark):
    docs = documents(spark, AWKWARD)
    out = mixing.mixed(docs, keep=1.0)
    assert out.columns == docs.columns and out.count() > 0
    assert mixing.mixed(docs.limit(0)).count() == 0


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = documents(spark, [(i if i is None else 10_000 + i, t) for i, t in AWKWARD]).select(docs.columns)
    docs = docs.unionByName(extra)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert set(docs.columns) <= set(out.columns) and out.count() <= docs.count()
        empty = stage(spark, docs.limit(0), SF)
        assert empty.count() == 0
        if name == "n-gram Jaccard join":
            rows = [(r["doc_id"], r["text"]) for r in docs.where("doc_id is not null").collect()]
            want = {i for i, (_, c) in brute_components(rows).items() if i == c}
            kept = [r["doc_id"] for r in out.collect() if r["doc_id"] is not None]
            assert sorted(kept) == sorted(want)
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_raking_ends_alike_on_either_side_of_the_switch():
    assert (mixing.TOLERANCE_BEYOND, mixing.ROUNDS_BEYOND) == (mixing.TOLERANCE, mixing.MOST_ROUNDS)
