"""op11 to op13: against plain twins, and on the cases of their docstrings."""

import math
import random
import re
import zlib
from collections import Counter

import pytest

from fieldlark.llm import collocations, quality_rules, variants
from fieldlark.llm.queries import ORACLE_SQL, QUERIES
from oracle import compare

SCHEMA = "doc_id long, text string, lang string, score double, n_words string"
NEW = ("op11_quality_rules", "op12_spelling_variants", "op13_collocations")


@pytest.mark.parametrize("name", NEW)
def test_sql(spark, name):
    compare(spark, QUERIES[name], ORACLE_SQL[name])


def awkward(spark, texts):
    rows = [(i, t, ("en", "de", None)[i % 3], None, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, (None, None, None, None, None), (None, "a", "en", 1.0, None)], SCHEMA)


# ---- op11 ----


def base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    often, inside = Counter(windows), set()
    for i, x in enumerate(windows):
        if often[x] > 1:
            inside.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


def divergence(p, q):
    return math.sqrt(sum(x * math.log2(2 * x / (x + y)) for a, b in zip(p, q, strict=True) for x, y in ((a, b), (b, a)) if x) / 2)


def classes(text):
    w = re.sub(r"[\x20\x09-\x0D]+", "", text)
    part = [len(text) - len(w), *(len(re.findall(c, text)) for c in ("[A-Z]", "[0-9]", "[#*$%&|<>]")), len(text.encode()) - len(text)]
    return [*part, len(text) - sum(part[:4])]


def test_rules_equal_a_plain_twin(spark, monkeypatch):
    monkeypatch.setattr(quality_rules, "MIN_REFERENCE", 400)
    r = random.Random(3)
    vocabulary = ["the", "of", "and", "Ümläut", "x1", "🎈", "#", "$a"] + [f"word{i}" for i in range(40)]
    texts = [None, "", " \t\n", "one two"]
    for _ in range(40):
        w = [r.choice(vocabulary[: r.choice([5, 40])]) for _ in range(r.randint(0, 120))]
        texts.append(r.choice([" ", "\n", "  \x0b"]).join(w + w[: r.choice([0, 0, 12])]))
    texts += ["a b c d e f g h " * 30, "same line here\n" * 5, texts[10]]
    docs = awkward(spark, texts)
    got = quality_rules.judged(docs, quality_rules.references(docs)).collect()
    rows = docs.collect()
    n = {k: sum(base(x.text)[0] for x in rows if x.lang == k or k == "") for k in ("en", "de", "")}
    refs = {}
    for k in n:
        some = [x.text or "" for x in rows if x.lang == k or k == ""]
        top = sorted(Counter(w for t in some for w in re.findall(r"[^\x20\x09-\x0D]+", t)).items(), key=lambda x: (-x[1], x[0].encode()))[: quality_rules.COMMON]
        of = [sum(c) for c in zip(*map(classes, some), strict=True)]
        refs[k] = [w for w, _ in top], [c / n[k] for _, c in top] + [1 - sum(c for _, c in top) / n[k]], [c / sum(of) for c in of]
    assert len(got) == len(rows) and min(n.values()) >= 400
    for x in got:
        text = x.doc.text or ""
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == base(text)
        assert x.base_failed == (x.n_words < 20 or 100 * x.n_repeat_words > 30 * x.n_words)
        words, word_shares, class_shares = refs[x.doc.lang or ""]
        if x.word_chars >= quality_rules.MIN_CHARS:
            c = classes(text)
            assert math.isclose(x.char_distance, divergence([y / sum(c) for y in c], class_shares), abs_tol=1e-7)
        if x.n_words >= quality_rules.MIN_WORDS:
            f = Counter(re.findall(r"[^\x20\x09-\x0D]+", text))
            p = [f[w] / x.n_words for w in words]
            assert math.isclose(x.word_distance, divergence([*p, 1 - sum(p)], word_shares), abs_tol=1e-7)


def test_rules_reject_strange_histograms_only(spark):
    r = random.Random(5)
    common = ["the", "of", "and", "to", "in", "is", "that", "was"]
    prose = [" ".join(r.choice(common) if r.random() < 0.5 else "".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(200)) + "." for _ in range(40)]
    shouted, table = prose[0].upper(), " | ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(200))
    docs = spark.createDataFrame([(i, t, "en", None, "x") for i, t in enumerate([*prose, shouted, table])], SCHEMA)
    kept = quality_rules.kept(docs)
    assert kept.columns == docs.columns
    assert {x.doc_id for x in kept.collect()} == set(range(40))


def test_rules_without_rows_and_on_one_long_text(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert quality_rules.judged(docs, quality_rules.references(docs)).count() == 0
    long = " ".join(f"w{i % 60000}" for i in range(150000))
    docs = spark.createDataFrame([(1, long, "xx", None, None)], SCHEMA)
    x = quality_rules.judged(docs, quality_rules.references(docs)).first()
    assert (x.n_words, x.n_repeat_words, x.base_failed, x.kept) == (150000, 150000, True, False)


# ---- op12 ----


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variant_twin(docs):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            run = run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run
            if len(run) >= 7:
                n[run] += 1
    n = {w: c for w, c in n.items() if c > 1}
    out = {}
    for w in n:
        close = sorted((-n[b], b) for b in n if near(w, b))
        out[w] = close[0][1] if close and -close[0][0] >= 10 * n[w] else None, len(close)
    rows = set()
    for w in n:
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.add((w, out[w][0], root, n[w], out[w][1], n.get(out[w][0])))
    return rows


@pytest.mark.parametrize("chunk", [1 << 19, 300])
def test_variants_equal_a_plain_twin(spark, monkeypatch, chunk):
    """With a chunk of 300 code points, nearly every key is hot and dealt into blocks."""
    monkeypatch.setattr(variants, "CHUNK", chunk)
    r = random.Random(chunk)
    words = ["".join(r.choice("abÀé") for _ in range(r.randint(6, 9))) for _ in range(120)] + ["aaaaaaa" + "b" * k for k in range(4)]
    text = [w.upper() if r.random() < 0.2 and w.isascii() else w for w in words for _ in range(r.choice([1, 2, 3, 40, 500]))]
    text += ["linkaaa"] * 6 + ["linkbaa"] * 120 + ["linkbba"] * 4000
    r.shuffle(text)
    rows = [(i, r.choice([" ", "-", "×1"]).join(text[i::7])) for i in range(7)] + [(None, " ".join(words[:60])), (8, None), (9, ""), (1, "Łaaaaaaa aaaaaaa")]
    docs = spark.createDataFrame([(i, t, "q") for i, t in rows], "doc_id long, text string, word string")
    found = {tuple(x) for x in variants.forms(variants.stored(variants.vocabulary(docs))).collect()}
    assert found == variant_twin(rows)
    assert any(x[1] for x in found) and any(x[2] != (x[1] or x[0]) for x in found)


def test_variants_cut_long_texts_between_words(spark, monkeypatch):
    monkeypatch.setattr(variants, "PIECE", 5)
    rows = [(1, "Überlänge überlänge " * 3 + "x" * 50 + " " + "x" * 50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    batches = docs.toArrow().to_batches()
    assert sum((Counter(dict(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))) for b in variants.count_words(iter(batches))), Counter()).keys() >= {"x" * 50}
    monkeypatch.undo()
    assert {(x[0], x[3]) for x in variant_twin(rows)} == {(x.word, x.n) for x in variants.vocabulary(docs).collect()}


def test_variants_without_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert variants.forms(variants.stored(variants.vocabulary(docs))).count() == 0


# ---- op13 ----


def phrase_twin(rows, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    found = {}
    for p, a in f.items():
        if a >= 10 and len(p) > 2:
            cuts = [(10**6 * a * a // (f[p[: k + 1]] * f[(p[0], *p[k + 1 :])]), k, f[p[: k + 1]], f[(p[0], *p[k + 1 :])]) for k in range(1, len(p) - 1)]
            found[p] = a, min(cuts)
    out = []
    for p, (a, (score, _, left, right)) in found.items():
        if not (len(p) == 3 and any(len(q) == 4 and q[0] == p[0] and p[1:] in (q[1:3], q[2:4]) and 100 * b >= 50 * a for q, (b, _) in found.items())):
            out.append((p[0], " ".join(p[1:]), a, left, right, n[p[0]], score))
    ranked = []
    for lang in n:
        some = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))[:top]
        ranked += [(x[0], i + 1, *x[1:]) for i, x in enumerate(some)]
    return sorted(ranked)


@pytest.mark.parametrize(("top", "nodes", "piece"), [(2000, 10**6, 1 << 18), (3, 10**6, 1 << 18), (7, 0, 40)])
def test_phrases_equal_a_plain_twin(spark, monkeypatch, top, nodes, piece):
    """Small tops let the frontier be settled in rounds; without nodes in the tasks, phrases are kept by joins; small pieces run on."""
    for k, v in {"TOP": top, "FIRST": top, "WIDER": 2, "NODES": nodes, "PIECE": piece, "HELD": 50, "TOGETHER": 100 if nodes == 0 else 1 << 20}.items():
        monkeypatch.setattr(collocations, k, v)
    r = random.Random(top)
    fixed = ["New York City", "at the end of", "ÄÖ ü", "on the other hand", "a a a a"]
    rows = [(("en", "de", None)[i % 3], r.choice([" ", "  ", ", ", "\t"]).join(r.choice([*fixed, *"abcdefgh"]) for _ in range(90))) for i in range(24)]
    rows += [("en", None), (None, ""), ("fr", "few words"), ("en", rows[0][1]), ("en", " ".join(["x y z"] * 200))]
    docs = spark.createDataFrame([(t, lang, 1.0) for lang, t in rows], "text string, lang string, score double")
    got = sorted(tuple(x) for x in collocations.collocations(docs).collect())
    assert got == phrase_twin(rows, top)


def test_phrases_without_rows(spark):
    docs = spark.createDataFrame([], "text string, lang string")
    found = collocations.collocations(docs)
    assert found.count() == 0 and found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    docs = spark.createDataFrame([("one two", "en")], "text string, lang string")
    assert collocations.collocations(docs).count() == 0


def test_scores_are_exact(spark):
    row = spark.sql("select 3000000000000000L a, 3000000000000001L l, 2999999999999999L r").select(collocations.score(*(collocations.F.col(c) for c in "alr")).alias("s"), "a", "l", "r").first()
    assert row.s == 10**6 * row.a**2 // (row.l * row.r)
