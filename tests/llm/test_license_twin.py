"""op6 against plain logits and trigram shares by dictionaries, line by line."""

import math
import re

from fieldlark.llm import licenses
from oracle import SF


def plain_words(line):
    return [w for w in re.sub(r"[^a-z0-9.\-]+|\.(?=[^a-z0-9]|$)", " ", line.lower()).split(" ") if w]


def plain_grams(w, orders=(1, 2, 3)):
    return {" ".join(w[i : i + n]) for n in orders for i in range(len(w) - n + 1)}


def plain_scan(text, model):
    """{paragraph: (family, probability, similarity)} of the lines that a family wins, each by itself."""
    weights, out = dict(zip(model.vocabulary, model.weights, strict=True)), {}
    for i, line in enumerate(re.split("\r?\n", text or "")):
        grams = plain_grams(plain_words(line))
        raw = [b + sum(weights[g][k] for g in grams if g in weights) for k, b in enumerate(model.intercepts)]
        top = max(raw)
        family = model.classes[raw.index(top)]
        if family == licenses.UNKNOWN:
            continue
        own = plain_grams(plain_words(line), (3,))
        shares = [len(own & t) / max(min(len(own), len(t)), 1) for t in (plain_grams(plain_words(x), (3,)) for x in licenses.TEMPLATES[family])]
        out[i] = family, 1 / sum(math.exp(x - top) for x in raw), max(shares)
    return out


def test_lines_equal_plain_logits(spark):
    """Whole documents of the tables and every template, with an empty line after each line, so that no run is joined."""
    source = spark.read.parquet(f"{SF}/documents.parquet")
    model = licenses.train(source)
    texts = [r["text"] for r in source.orderBy("doc_id").limit(60).collect()]
    texts += ["\n".join(t) for t in licenses.TEMPLATES.values()] + [None, "", "the software is", "All rights reserved.\r\nMIT License"]
    rows = [(i, t if t is None else re.sub("\r?\n", "\n\n", t)) for i, t in enumerate(texts)]
    got = {(r["doc_id"], r["paragraph"]): r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    want = {(i, p): x for i, t in rows for p, x in plain_scan(t, model).items()}
    assert set(got) == set(want) and len(want) > 20
    for k, (family, probability, similarity) in want.items():
        r = got[k]
        assert r["family"] == family and r["last_line"] == k[1] and r["confirmed"] == (similarity >= licenses.CONFIRM)
        assert math.isclose(r["probability"], probability, rel_tol=1e-6) and math.isclose(r["similarity"], similarity, abs_tol=1e-12)
