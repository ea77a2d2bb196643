"""Operators against plain-Python twins, and the cases that each docstring defines."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_llm import AWKWARD, SF, documents

import corpus_pipeline
from fieldlark.llm import _text as T
from fieldlark.llm import decontaminate, extract, jaccard_join, knn, language, licenses, mixing, quality, toxicity, warc

M64 = (1 << 64) - 1


# ------------------------------------------------------------- texts in pieces


@pytest.mark.parametrize("size", [7, 64, 1 << 18])
def test_pieces_hash_like_whole_texts(monkeypatch, size):
    texts = ["one two", "x" * 500 + " é" * 40 + " " + "word " * 100, "", None, "tail" * 30]
    whole = [T.words(raw, at, T.SPACE) for _, raw, at in T.chunks(pa.array(texts))]
    monkeypatch.setattr(T, "CHUNK", size)
    parts = [T.words(raw, at, T.SPACE) for _, raw, at in T.chunks(pa.array(texts))]
    assert np.concatenate([x[0] for x in whole]).tolist() == np.concatenate([x[0] for x in parts]).tolist()
    assert [n for x in whole for n in np.diff(x[1])] == [n for x in parts for n in np.diff(x[1])]
    counts = [c for _, raw, at in T.chunks(pa.array(texts)) for c in T.counts(raw, at).tolist()]
    assert counts == [[(t or "").encode().count(bytes([b])) for b in range(256)] for t in texts]


# ------------------------------------------------------------- naive Bayes


def plain_mix(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & M64
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & M64
    return x ^ (x >> 31)


def plain_grams(text):
    odd = [int(x) for x in language._ODD]
    fold = [ord(c.lower()) if c.isalpha() and len(c.lower()) == 1 else ord(c) if c.isalpha() else 32 for c in text or ""]
    text, out = [32, *fold, 32], []
    for n in language.ORDERS:
        for i in range(len(text) - n + 1):
            if any(c != 32 for c in text[i : i + n]):
                out.append(plain_mix((sum(c * o for c, o in zip(text[i : i + n], odd)) + n) & M64) % language.BUCKETS)
    return out


def test_naive_bayes_by_dictionaries(spark):
    source = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(90).select("doc_id", F.substring("text", 1, 900).alias("text"), "lang").collect()
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in source] + [(1000 + (i or 0), (t or "")[:2000] if t is not None else None, None) for i, t in AWKWARD]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    counts = defaultdict(Counter)
    for _, t, lang in rows:
        if lang is not None and t is not None:
            counts[lang].update(plain_grams(t))
    names = sorted(counts)
    log = {c: [math.log((counts[c][b] + language.ALPHA) / (sum(counts[c].values()) + language.ALPHA * language.BUCKETS)) for b in range(language.BUCKETS)] for c in names}
    got_names, matrix = language.train(docs)
    assert got_names == names
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(docs, got_names, matrix).collect()}
    for i, t, _ in rows:
        grams = plain_grams(t)
        if not grams:
            assert got[i] == ("und", 0.0)
            continue
        scores = {c: sum(log[c][b] for b in grams) * min(1, language.EVIDENCE / len(grams)) for c in names}
        top = max(scores.values())
        assert abs(got[i][1] - 1 / sum(math.exp(s - top) for s in scores.values())) < 1e-3
        assert scores[got[i][0]] > top - 1e-3


def test_language_in_small_pieces_and_blocks(monkeypatch):
    texts = pa.array(["où est la gare? " * 40, "the cat sat on the mat " * 30, "a", "é" * 300, None, ""])
    names, matrix = [f"l{i}" for i in range(7)], np.log(np.random.RandomState(1).rand(language.BUCKETS, 7)).astype(np.float32)
    want = language.classified(texts, names, [matrix])
    monkeypatch.setattr(language, "PIECE", 16)
    monkeypatch.setattr(language, "CELLS", 4)
    monkeypatch.setattr(language, "STEP", 2)
    got = language.classified(texts, names, [matrix[:, :3], matrix[:, 3:]])
    assert got[0].equals(want[0]) and np.allclose(np.array(got[1]), np.array(want[1]), atol=1e-5)


def test_many_languages(spark):
    docs = spark.range(1300).select(F.col("id").alias("doc_id"), F.concat(F.lit("text of "), F.conv(F.col("id").cast("string"), 10, 36)).alias("text"), F.concat(F.lit("l"), F.col("id").cast("string")).alias("lang"))
    names, matrix = language.train(docs)
    assert len(names) == 1300 and language.predict(docs.limit(5), names, matrix).count() == 5


# ------------------------------------------------------------- discriminant


def test_discriminant_by_linear_algebra(spark):
    r = random.Random(8)
    make = lambda bad: "\n".join(" ".join(r.choice("alpha beta GAMMA delta 12 x% | the".split() if bad else "alpha beta gamma delta the of and".split()) for _ in range(r.randrange(4, 20))) + "." for _ in range(r.randrange(1, 6)))
    rows = [(i, make(i % 3 == 0)) for i in range(120)]
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(0, 120, 2)], "doc_id long, quality int")
    x = quality.document_statistics(documents(spark, rows))
    got = {z["doc_id"]: z["score"] for z in quality.scored(x, quality.fit(x, labels, "quality")).collect()}
    values = {z["doc_id"]: np.array(z["x"]) for z in x.collect()}
    groups = [np.stack([values[i] for i in range(0, 120, 2) if int(i % 3 != 0) == c]) for c in (0, 1)]
    scatter = [(g - g.mean(0)).T @ (g - g.mean(0)) for g in groups]
    pooled = sum(scatter) / 60 + 1e-6 * np.eye(quality.D)
    own = 1 - quality.SHRINK_POOLED - quality.SHRINK_DIAGONAL
    cov = [own * s / len(g) + quality.SHRINK_POOLED * pooled + quality.SHRINK_DIAGONAL * np.diag(np.diag(pooled)) for s, g in zip(scatter, groups)]
    for i, v in values.items():
        log = [math.log(len(g) / 60) - 0.5 * (np.linalg.slogdet(c)[1] + (v - g.mean(0)) @ np.linalg.solve(c, v - g.mean(0))) for g, c in zip(groups, cov)]
        assert abs(got[i] - 1 / (1 + math.exp(min(700, log[0] - log[1])))) < 1e-6


def test_statistics_by_counting():
    text = "The QUICK fox, 12 dogs!\nThe QUICK fox, 12 dogs!\n\nab | cd"
    x = dict(zip(quality.NAMES, quality.statistics(pa.array([text]))[0], strict=True))
    words, lines = text.split(), [s for s in text.split("\n") if s]
    logit = lambda a, n: math.log((a + 0.5) / (n - a + 0.5))
    chars = sum(map(len, words))
    assert math.isclose(x["words"], math.log1p(len(words))) and math.isclose(x["distinct"], math.log1p(len(set(map(str.lower, words)))) - math.log1p(len(words)))
    assert math.isclose(x["upper"], logit(sum(c.isupper() for c in text), sum(c.isalpha() for c in text))) and math.isclose(x["digit"], logit(4, chars))
    assert math.isclose(x["repeated_lines"], logit(1, 3)) and math.isclose(x["line_length"], math.log1p(chars) - math.log1p(len(lines)))


# ------------------------------------------------------------- string kernel


def test_scores_by_direct_kernels():
    """Every word of every sentence against every landmark, without filter, windows or memory."""
    r = random.Random(5)
    marks = toxicity.Landmarks(["idiot", "scum", "\x02noob", "moron"])
    weight, slopes = np.array([1.3, 0.7, 0.9, 1.1]), np.array([1.5, 0.6, -0.2])
    model = toxicity.Model(0.3, marks, weight, -1.0, slopes)
    pool = ["idiot", "i-d-i-o-t", "(scum)", "s*c*u*m", "noob", "xnoob", "MORON", "mo.ron", "plain", "words", "stand", "here", "too!", "end.", "why?"]
    texts = [" ".join(r.choice(pool) for _ in range(r.randrange(0, 14))) for _ in range(60)] + [None, "", "...", "word\nidiot"]

    def value(word):
        b = word.encode()
        first = next((i for i, c in enumerate(b) if not T.NONWORD[c]), 0)
        b = bytes([2]) + bytes(c + 32 if 65 <= c <= 90 else c for c in (b[first:] or b[-1:]))
        row = np.zeros((1, 64), np.uint8)
        row[0, : len(b)] = list(b)
        out = np.array([min(1.0, toxicity.kernel(row, z)[0] / own) for z, own in zip(marks.z, marks.own)])
        return np.where(out < toxicity.FAINT, 0, out**2)

    for t, got in zip(texts, model.score(pa.array(texts), toxicity.Reader(marks)), strict=True):
        sentences, ends = defaultdict(lambda: np.zeros(4)), [i for i, c in enumerate(t or "") if c in "\n\r!.?"]
        for m in re.finditer(r"\S+", t or ""):
            v = value(m.group())
            if v.any():
                sentences[sum(e < m.start() for e in ends)] += v
        margins = sorted((float(np.minimum(v, toxicity.MOST) @ weight) - 1.0 for v in sentences.values()), reverse=True)
        two = [max([-1.0, *margins[:1]]), max([-1.0, *margins[1:2]])]
        assert abs(got - 1 / (1 + math.exp(-(two[0] * slopes[0] + two[1] * slopes[1] + slopes[2])))) < 1e-9


@pytest.mark.parametrize("remember, batch", [(50, 1), (50, 20), (3000, 1000), (2_000_000, 20)])
def test_scores_do_not_depend_on_batches(spark, monkeypatch, remember, batch):
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(80).collect()] + ["x" * 5000 + "idiot" + "y" * 5000, "id.iot " * 3000]
    marks = toxicity.Landmarks(["idiot", "tion", "\x02the"])
    model = toxicity.Model(0.3, marks, np.array([1.0, 0.2, 0.1]), -1.0, np.array([1.0, 0.5, 0.0]))
    want = model.score(pa.array(texts), toxicity.Reader(marks))
    monkeypatch.setattr(toxicity, "REMEMBER", remember)
    monkeypatch.setattr(toxicity, "BLOCK", 100)
    monkeypatch.setattr(T, "CHUNK", 1000)
    reader = toxicity.Reader(marks)
    got = np.concatenate([model.score(pa.array(texts[i : i + batch]), reader) for i in range(0, len(texts), batch)])
    assert np.allclose(got, want, atol=1e-12) and len(reader.known) <= max(remember, 5000)


# ------------------------------------------------------------- templates


def parsed(html):
    """Blocks and elements by their whole paths: ({path: hash}, [(path, text, noise, role)], [path])."""
    found, e = extract.blocks(html)
    paths = [""]
    for i in range(1, len(e.paths)):
        paths.append(f"{paths[e.parents[i]]}>{e.paths[i]}.{e.tags[i]}")
    return dict(zip(paths, e.paths, strict=True)), [(paths[i], s, noise, role) for i, s, noise, role in found], paths[1:]


def plain_template(pages):
    """Classes of tokens with equal occurrence vectors, by dictionaries: (constants, slots, container) of one host."""
    tokens, hashes = [], {}
    for html in pages:
        of, found, paths = parsed(html)
        hashes |= of
        seen = {}
        for p, s in [(p, "") for p in paths] + [(p, s) for p, s, noise, _ in found if not noise]:
            seen.setdefault((p, s), [0, len(seen)])[0] += 1
        tokens.append(seen)
    vectors = {x: tuple(t.get(x, [0])[0] for t in tokens) for t in tokens for x in t}
    classes = defaultdict(list)
    for x, v in vectors.items():
        if sum(n > 0 for n in v) >= extract.SUPPORT * len(pages) and len(pages) >= extract.LEAST_PAGES:
            classes[v].append(x)
    root = tuple(1 for _ in pages)  # the document itself, which is on every page once
    valid = []
    for v, members in classes.items():
        orders = {tuple(sorted(members, key=lambda x: t[x][1])) for t, n in zip(tokens, v) if n}
        if len(members) + (v == root) > 1 and len(orders) == 1:
            valid += members
    constants, nodes = {x for x in valid if x[1]}, {p for p, s in valid if not s}
    chars = Counter()
    for t in tokens:
        for (p, s), (n, _) in t.items():
            if s and (p, s) not in constants:
                chars[p] += n * len(s)
    around = {p: [q for q in nodes if p == q or p.startswith(q + ">")] for p in chars}
    slots = {max(q, key=lambda x: x.count(">")) for q in around.values() if q}
    held = {q: sum(n for p, n in chars.items() if q in around[p]) for q in nodes if q.rpartition(".")[2] in extract.BOXES}
    boxes = [q for q, n in held.items() if n >= extract.MOST_TEXT * sum(chars.values())]
    return {extract.token(hashes[p], s) for p, s in constants}, {hashes[p] for p in slots}, hashes.get(max(boxes, key=lambda x: x.count(">"), default=None))


def plain_text(html, constants, slots, container):
    """page_text from whole paths: blocks of the wanted role that are no constants, in slots inside the container."""
    of, found, _ = parsed(html)
    keep = [(p, s, role) for p, s, noise, role in found if not noise]
    wanted = next((x for x in ("article", "spare", "main") if any(x == r for _, _, r in keep)), "")
    keep = [(p, s) for p, s, r in keep if not wanted or r == wanted]
    rest = [(p, s) for p, s in keep if extract.token(of[p], s) not in constants]
    gone, whole = sum(len(s) for x in keep if x not in rest for s in x[1:]), sum(len(s) for _, s in keep)
    if gone <= (extract.MOST_CONSTANT if wanted in ("article", "spare") else extract.MOST_ELSEWHERE) * whole:
        keep = rest
    if not wanted and slots:
        up = lambda p: [of[">".join(p.split(">")[:k])] for k in range(1, len(p.split(">")) + 1)]
        keep = [(p, s) for p, s in keep if container in up(p) and slots & set(up(p))] or keep
    return "\n\n".join(s for _, s in keep)


def host_pages(host, seed, n):
    r = random.Random(seed)
    prose = lambda k: " ".join(f"w{r.randrange(500)}" for _ in range(k))
    out = []
    for i in range(n):
        extra = f"<div class='promo-box'><p>Read more</p><p>{prose(3)}</p></div>" if r.random() < 0.5 else ""
        out.append((host * 1000 + i, f"http://h{host}.example/{i}", f"<html><body><div class='top'><p>Our site</p></div><div class='story'><h2>{prose(4)}</h2><p>{prose(30)}</p><p>Share with friends</p>{extra}<p>{prose(20)}</p></div><div class='end'><p>All about us</p></div></body></html>"))
    return out


def test_template_deduction_twin(spark):
    rows = [x for h, n in ((1, 9), (2, 3), (3, 6)) for x in host_pages(h, h, n)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r["host"]: (set(r["constants"] or ()), set(r["slots"] or ()), r["container"]) for r in extract.templates(df.select(F.regexp_extract("url", "//([^/]*)", 1).alias("host"), F.col("page_id").alias("page"), "html")).collect()}
    for h in (1, 2, 3):
        want = plain_template([html for _, url, html in rows if f"//h{h}." in url])
        assert got.get(f"h{h}.example", (set(), set(), None)) == want
    story = next(h for html in (rows[0][2],) for p, h in parsed(html)[0].items() if h and any(extract._hash(x, "div.story") == h for x in parsed(html)[0].values()))
    assert got["h1.example"][0] and got["h1.example"][2] == story
    texts = {r["page_id"]: r["text"] for r in extract.extract(df).collect()}
    for page, _, html in rows:
        text, plain = texts[page], extract.page_text(html)
        assert text == plain_text(html, *got.get(f"h{page // 1000}.example", (set(), set(), None)))
        if page < 2000 or page >= 3000:
            assert "Share with friends" not in text and "Our site" not in text and plain != text
        else:
            assert text == plain  # too few pages for a template


def test_template_works_inside_articles_and_leaves_copies_alone(spark):
    page = "<html><body><nav>N</nav><article><h1>{0}</h1><p>{1}</p><p>Sign up for our letter</p><p>{2}</p></article></body></html>"
    r = random.Random(3)
    prose = lambda k: " ".join(f"w{r.randrange(500)}" for _ in range(k))
    same = [prose(40) for _ in range(4)]
    rows = [(i, f"http://a.example/{i}", page.format(prose(5), prose(40), prose(30))) for i in range(6)]
    rows += [(100 + i, f"http://b.example/{i}", page.format(same[0], same[1], prose(3) if i % 2 else same[2])) for i in range(6)]
    rows += [rows[0], rows[0]]
    df = spark.createDataFrame([(*x, "clash", 1) for x in rows], "page_id long, url string, html string, host string, page int")
    got = sorted((x["page_id"], x["text"], x["n_chars"]) for x in extract.extract(df).collect())
    assert len(got) == len(rows) and all(n == len(t) for _, t, n in got)
    for i, text, _ in got:
        assert ("Sign up" in text) == (i >= 100) and text.count("\n\n") == (2 if i < 100 else 3)


@pytest.mark.parametrize(
    "page, text",
    [
        ('<article class="story form"><p>Body text</p></article>', "Body text"),
        ('<article><p class="legal">keep</p><p>a <math><mi>x</mi></math></p></article>', "keep\n\na x"),
        ("<p>a <span hidden>gone <b>too</b></span>b</p>", "a b"),
        ('<table><tr><td class="sidebar">Side <p>menu</p></td><td>x</td><td>y</td></tr></table>', "x y"),
        ('<article><p>A</p><div class="comments">c</div></article><article class="comment">me</article>', "A"),
        ('<article><p>A</p><section id="discussion"><p>B</p></section><div class="legal">C</div><section class="form"><p>D</p></section><div class="wp-block-share-price">E</div><nav>no</nav><div hidden>no</div><aside>no</aside></article>', "A\n\nB\n\nC\n\nD\n\nE"),
        ("<article><h1>T</h1><p>x" + " y" * 200_000, "T\n\nx" + " y" * 200_000),
    ],
)
def test_pages_by_structure(page, text):
    assert extract.page_text(page) == text


def test_deep_nesting(spark, monkeypatch):
    """20 000 nested elements take memory in proportion; so do their tokens, and templates that are joined give the same texts."""
    import tracemalloc

    deep = "<div>" * 20_000 + "<p>deep text" + "</div>" * 20_000
    tracemalloc.start()
    assert extract.page_text(deep) == "deep text"
    tokens = sum(b.num_rows for b in extract._tokens(iter([pa.RecordBatch.from_pydict({"host": ["h"], "page": [1], "html": [deep]})])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50e6 and 20_000 < tokens < 20_010
    rows = [(i, "http://d.example/", f"<div>top</div>{'<div class=x>' * 3000}<p>text {i} of this page</p>") for i in range(4)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = {i: f"text {i} of this page" for i in range(4)}
    assert {r["page_id"]: r["text"] for r in extract.extract(df).collect()} == want
    monkeypatch.setattr(extract, "MOST_BROADCAST", 0)
    assert {r["page_id"]: r["text"] for r in extract.extract(df).collect()} == want


# ------------------------------------------------------------- search


def test_bounds_spare_cells_of_clustered_vectors(spark):
    r = np.random.RandomState(3)
    centres = r.normal(0, 1, (30, 24))
    rows = [(i % 1500, (centres[i % 30] + r.normal(0, 0.05, 24)).tolist(), 1, 2) for i in range(1600)]
    data = knn.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, cell int, score long")).persist()
    report = {}
    got = {(x["query_id"], x["rank"]): x["score"] for x in knn.top_k(data, data.where("vec_id % 300 = 299"), 5, report).collect()}
    assert report["compared"] < 0.5 * report["pairs"]
    vectors = [(x["vec_id"], np.array(x["v"])) for x in data.collect()]
    for q, v in vectors:
        if q % 300 == 299:
            best = sorted((-int(v @ w) for i, w in vectors if i != q))[:5]
            assert [got[q, k + 1] for k in range(5)] == [-s for s in best]


# ------------------------------------------------------------- mixing


def test_details_replace_their_own_names(spark):
    docs = documents(spark, AWKWARD).withColumns({"mix_tokens": F.lit(1), "mix_topic": F.lit("x"), "mix_probability": F.lit(0.0), "mix_weight": F.lit(5)})
    once = mixing.mixed(docs, keep=1.0, details=True)
    assert mixing.mixed(once, keep=1.0, details=True).count() > 0 and len(set(once.columns)) == len(once.columns) and "mix_weight" in once.columns


def test_query_meets_its_marginals(spark):
    """Expected tokens of every value within a hundredth of the whole of its target, or all of the value's tokens."""
    docs = spark.read.parquet(f"{SF.replace('sf0.001', 'sf0.01')}/documents.parquet")
    named = mixing._with_cells(docs, "text", "source", "lang", {c: f"mix_{c}" for c in ("n", *mixing.DIMENSIONS)})
    cells = named.groupBy(*(F.col(f"mix_{d}").alias(d) for d in mixing.DIMENSIONS)).agg(F.sum("mix_n").alias("tokens"))
    goals = mixing._targets(cells, None)
    raked = mixing.rake_bounded(cells, goals).collect()
    amount = mixing.KEEP * sum(r["tokens"] for r in raked)
    assert abs(sum(r["tokens"] * r["weight"] for r in raked) - amount) < 0.01 * amount
    for d in ("source", "lang"):
        for v, share in goals[d].items():
            own = [r for r in raked if r[d] == v]
            held, whole = sum(r["tokens"] * r["weight"] for r in own), sum(r["tokens"] for r in own)
            assert abs(held - share * amount) < 0.01 * amount or held > 0.999 * whole


# ------------------------------------------------------------- licences


def test_wrapped_and_awkward_notices(spark):
    mit = licenses.TEMPLATES["mit"][2].split()
    wrapped = "\n".join([" ".join(mit[:12]), " ".join(mit[12:22]), " ".join(mit[22:])])
    rows = [(1, f"Some words here\n{wrapped}\nand more of them"), (2, "Released under the MIT License.\nLicensed under CC BY 4.0."), (3, None), (4, ""), (5, "x" * 300_000 + "\nReleased under the MIT License."), (6, "Released under the MIT License."), (6, "Released under the MIT License."), (None, "Released under the MIT License.")]
    docs = documents(spark, rows).withColumn("paragraph", F.lit("clash"))
    model = licenses.train(spark.read.parquet(f"{SF}/documents.parquet"))
    got = sorted((r["doc_id"] or 0, r["paragraph"], r["last_line"], r["family"]) for r in licenses.scan(docs, model).where("confirmed").collect())
    assert got == [(0, 0, 0, "mit"), (1, 1, 3, "mit"), (2, 0, 0, "mit"), (2, 1, 1, "cc-by"), (5, 1, 1, "mit"), (6, 0, 0, "mit"), (6, 0, 0, "mit")]
    assert licenses.scan(docs.limit(0), model).count() == 0


# ------------------------------------------------------------- archives


def test_archives_are_bounded_by_bytes(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 4000)
    monkeypatch.setattr(warc, "CLASSES", (500, 2000))
    lengths = [0, 1, 499, 500, 501, 1999, 2000, 2001, 30_000, 30_000] * 3
    rows = [(i, f"http://h{i % 3}.org/{i}", None if n == 0 else chr(97 + i % 20) * n) for i, n in enumerate(lengths)]
    path = str(tmp_path / "bounded")
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), path)
    files = [r["content"] for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content").collect()]
    held = [[len(block.partition(b"\r\n\r\n")[2]) for f, block in warc.records_in(bytes(x)) if f["warc-type"] in ("response", "revisit")] for x in files]
    assert all(sum(x) <= 4000 or len(x) == 1 for x in held) and sum(len(x) > 1 for x in held) > 1
    full = warc.assemble(warc.read_warc(spark, path)).collect()
    assert len(full) == len(rows) and all(r["request"] and r["metadata"] for r in full)
    first = {}
    for i, _, text in rows:
        first.setdefault(text, i)
    page = lambda fields: int(fields["page-id"])
    got = {page(r["metadata"]["fields"]): page(r["original_fields"]) if r["original"] else page(r["metadata"]["fields"]) for r in full}
    assert got == {i: first[text] for i, _, text in rows}


def test_archives_in_small_pieces(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(warc, "PIECE", 5)
    pages = spark.range(40).select(F.col("id").alias("page_id"), F.lit("http://a/b").alias("url"), F.repeat(F.lit("zé "), (F.col("id") % 7).cast("int")).alias("html"), F.lit(1).alias("row"))
    path = str(tmp_path / "w")
    warc.write_warc(pages.repartition(3, "html"), path)
    full = warc.assemble(warc.read_warc(spark, path, payload=False)).collect()
    assert len(full) == 40 and sum(r["response"]["record_type"] == "response" for r in full) == 7 and all(r["request"] and r["metadata"] for r in full)
    empty = str(tmp_path / "e")
    warc.write_warc(pages.limit(0), empty)
    assert warc.assemble(warc.read_warc(spark, empty)).count() == 0


# ------------------------------------------------------------- decontamination, near duplicates, pipeline


def test_text_ids_and_rows_without_ids(spark):
    items = spark.createDataFrame([("q1", "one two three four five six seven eight"), ("q2", "only three words"), ("q3", None)], "item_id string, text string")
    rows = [("a", "x one two three four five six seven eight y"), (None, "x one two three four five six seven eight y"), ("b", "only three words"), ("c", "nothing"), ("d", None)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id string, text string, shared int")
    assert {tuple(r) for r in decontaminate.contained_items(docs, items).select("doc_id", "item_id").collect()} == {("a", "q1"), ("b", "q2")}
    assert sorted(r["text"] or "" for r in decontaminate.clean(docs, items).collect()) == ["", "nothing"]
    assert decontaminate.clean(docs, items.limit(0)).count() == 5 and decontaminate.contained_items(docs.limit(0), items).count() == 0


def test_rows_that_share_an_id(spark):
    rows = [(7, f"text number {i} of several words that differ {i * i}") for i in range(6)]
    docs = documents(spark, rows)
    kept = {corpus_pipeline.jaccard_stage(spark, docs.repartition(n), SF).first()["text"] for n in (1, 3)}
    assert len(kept) == 1


def test_language_stage_learns_from_the_rows_of_its_query(spark, monkeypatch):
    seen = []
    train = language.train
    monkeypatch.setattr(language, "train", lambda docs, *a: seen.append(docs) or train(docs, *a))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    corpus_pipeline.language_stage(spark, docs, SF)
    assert sorted(r["doc_id"] for r in seen[0].select("doc_id").collect()) == sorted(r["doc_id"] for r in docs.where(~quality.held_out(3, 1)).select("doc_id").collect())


def test_classifiers_without_documents(spark):
    docs = documents(spark, []).select("doc_id", "text")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    x = quality.document_statistics(docs)
    assert quality.scored(x, quality.fit(x, labels, "quality")).count() == 0
    assert toxicity.scored(docs, toxicity.fit(docs, labels)).count() == 0
    assert language.predict(docs, *language.train(docs.withColumn("lang", F.lit("en")))).count() == 0


def test_stages_without_documents_and_with_extra_columns(spark):
    source = spark.read.parquet(f"{SF}/documents.parquet")
    few = source.where("doc_id < 40").withColumns({"score": F.lit(0.5), "root": F.lit(3), "class_id": F.lit("c"), "n": F.lit(1)})
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, source.limit(0), SF).count() == 0, name
        out = stage(spark, few, SF)
        assert set(few.columns) <= set(out.columns) and 0 < out.count() <= few.count(), name
        assert out.select("score", "root", "class_id", "n").distinct().collect() == [(0.5, 3, "c", 1)], name


def test_clusters_in_small_blocks(spark, monkeypatch):
    from test_llm import brute_components, near_copies

    monkeypatch.setattr(jaccard_join, "MEMBERS", 2)
    monkeypatch.setattr(jaccard_join, "PROBE", 1)
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    rows = near_copies(21, 100)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(documents(spark, rows)).collect()}
    assert got == brute_components(rows)


@pytest.mark.parametrize("block", [512, 5])
def test_every_link_is_counted(spark, monkeypatch, block):
    """n_links against all pairs of different sets: groups of near copies, copies, sizes in the ratio 4 to 5, repeated rows."""
    from test_llm import near_copies, shingle_set

    monkeypatch.setattr(jaccard_join, "COUNTED", block)
    rows = near_copies(33, 90)
    rows += [(500 + i, t.upper()) for i, t in rows[:30]] + [(600 + n, " ".join(f"w{j}" for j in range(n + 4))) for n in (64, 80, 81, 90, 100, 101, 125)]
    rows += [(900, "alone in the world of texts"), (901, "a pair of texts " * 9 + "one"), (902, "a pair of texts " * 9 + "one"), (903, ""), rows[7]]
    sets = {i: frozenset(shingle_set(t)) for i, t in rows}
    classes = {s for s in sets.values() if s}
    link = lambda a, b: a != b and 100 * (n := len(a & b)) >= 80 * (len(a) + len(b) - n)
    want = {i: sum(link(s, c) for c in classes) if s else 0 for i, s in sets.items()}
    got = {r["doc_id"]: r["n_links"] for r in jaccard_join.jaccard_components(documents(spark, rows)).collect()}
    assert got == want and max(want.values()) > 5
    assert "n_links" not in jaccard_join.jaccard_components(documents(spark, rows[:3]), links=False).columns
