"""HTML text, quality, toxicity and the pipeline against second, plain forms of the same definitions."""

import hashlib
import math
import random
import re
import zlib

import corpus_pipeline as cp
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_decontamination import naive_items
from test_near_copies import naive_pairs
from test_pairs import naive_fingerprint
from tokenizers import Tokenizer

from pluvia.llm.graph import forest
from pluvia.llm.html_text import render
from pluvia.llm.mixing import mix_sources
from pluvia.llm.quality import quality_scores
from pluvia.llm.token_counts import fill_cache, token_counts
from pluvia.llm.toxicity import ToxicityModel, fit_noisy_or, fit_toxicity, score_toxicity

WORD = public_tokenizers.path("word_bpe_49k.json")


def page(rnd, depth=0):
    """(html, lines): a random page of blocks and what it must show. Blocks are given as lists of lines with a blank between them."""
    html, blocks = [], []
    word = lambda: "".join(rnd.choices("abcdefg", k=rnd.randint(1, 6)))

    def inline():
        words = [word() for _ in range(rnd.randint(1, 5))]
        marked = [f"<{t}>{w}</{t}>" if (t := rnd.choice([None, None, "b", "i", "span", "a"])) else w for w in words]
        hidden = rnd.choice(["", "", "<script>no()</script>", "<span hidden>no</span>", "<i style='display:none'>no</i>", "<!-- no -->", "<b class=off>no</b>"])
        return rnd.choice([" ", "\n ", "  "]).join(marked) + hidden, " ".join(words)

    for _ in range(rnd.randint(1, 4)):
        kind = rnd.choice(["p", "h2", "ul", "ol", "table", "quote", "gone"] if depth < 2 else ["p", "h2"])
        if kind in ("p", "h2"):
            h, text = inline()
            html.append(f"<{kind}>{h}" + (f"</{kind}>" if kind == "h2" or rnd.random() < 0.5 else ""))
            blocks.append([text])
        elif kind in ("ul", "ol"):
            items = [inline() for _ in range(rnd.randint(1, 4))]
            html.append(f"<{kind}>" + "".join(f"<li>{h}" + rnd.choice(["", "</li>", " </li>\n"]) for h, _ in items) + f"</{kind}>")
            blocks.append([(f"{n}. " if kind == "ol" else "- ") + t for n, (_, t) in enumerate(items, 1)])
        elif kind == "table":
            rows = [[inline() for _ in range(3)] for _ in range(rnd.randint(1, 3))]
            stray = rnd.choice(["", "<form>", "<tbody>"])
            html.append("<table>" + stray + "".join(rnd.choice(["<tr>", "\n<tr> "]) + "".join(rnd.choice(["<td>", "<th>"]) + h + rnd.choice(["", "</td>" if rnd.random() < 0 else ""]) for h, _ in r) + rnd.choice(["", "</tr>"]) for r in rows) + "</table>")
            width = [max(len(r[c][1]) for r in rows) for c in range(3)]
            blocks.append(["  ".join(t.ljust(w) for (_, t), w in zip(r, width, strict=True)).rstrip() for r in rows])
        elif kind == "quote":
            h, lines = page(rnd, depth + 1)
            html.append(f"<blockquote>{h}</blockquote>")
            blocks.append(["  " + x if x else x for x in lines])
        else:
            html.append(rnd.choice(["<div hidden><p>no</div>", "<p class=off>no</p>", "<template><p>no</template>", "<style>.off{display:none}</style>"]))
    out = []
    for b in filter(None, blocks):
        out += [""] * bool(out) + b
    return "".join(html), out


def test_render_against_random_trees():
    rnd = random.Random(21)
    for _ in range(600):
        html, lines = page(rnd)
        whole = "<html><head><title>no</title><style>@media print{p,li,td,h2{display:none}} .off{display:none}</style>" + rnd.choice(["</head><body>", ""]) + html
        assert render(whole) == "\n".join(lines), html


def test_words_of_random_soup_are_never_lost():
    """Tags in any order: every word outside hidden elements is in the text, in whatever layout."""
    rnd = random.Random(22)
    tags = "p div table tr td th tbody ul li b i form h1 blockquote section span head body".split()
    for _ in range(400):
        parts, words = [], []
        for n in range(rnd.randint(1, 25)):
            t = rnd.choice(tags)
            parts.append(rnd.choice([f"<{t}>", f"</{t}>", f"<{t}>"]))
            if rnd.random() < 0.6:
                words.append(f"w{n}x")
                parts.append(words[-1])
        assert sorted(re.findall(r"w\d+x", render("".join(parts)))) == sorted(words), "".join(parts)


def test_quality_against_plain_loops(spark):
    rnd = random.Random(23)
    rows = [(i, " ".join(rnd.choices(["ab", "cd", "%%%", "||", "X1"], k=rnd.randint(0, 30))), f"h{rnd.randrange(4)}", f"p{rnd.randrange(5)}") for i in range(250)]
    rows += [(900, "ab cd", "alone", "only"), (901, "ab", None, None), (902, "cd", None, None)]
    labels = [(i, int("%" not in t)) for i, t, *_ in rows if i % 2]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    path = F.concat_ws("/", "source", "lang")
    got = {r["doc_id"]: r for r in quality_scores(df, spark.createDataFrame(labels, "doc_id long, quality int"), host=F.col("source"), path=path).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i, *_ in rows}
    y = {i: float(q) for i, q in labels if not held[i]}
    e = {i: y.get(i, got[i]["p_doc"]) for i, *_ in rows}
    where = {i: (s, "/".join(x for x in (s, lang) if x is not None)) for i, _, s, lang in rows}

    def strength(groups, centers):
        between = sum(n * (s / n - c) ** 2 for (n, s), c in zip(groups, centers, strict=True) if n > 1)
        binomial = sum(n * c * (1 - c) for (n, s), c in zip(groups, centers, strict=True) if n > 1)
        count, n = sum(n > 1 for n, _ in groups), sum(n for n, _ in groups if n > 1)
        if not count or not binomial or n <= count:
            return 1e6
        excess = between / binomial * n / count - 1
        return min(max((n / count - 1) / excess - 1 if excess > 0 else 1e6, 1.0), 1e6)

    sums = lambda k: {g: (sum(where[i][:k] == g for i in e), sum(v for i, v in e.items() if where[i][:k] == g)) for g in {where[i][:k] for i in e}}
    hosts, paths = sums(1), sums(2)
    rate = sum(e.values()) / len(e)
    a = strength(list(hosts.values()), [rate] * len(hosts))
    b = strength(list(paths.values()), [(a * rate + hosts[g[:1]][1]) / (a + hosts[g[:1]][0]) for g in paths])
    for i in e:
        (hn, hs), (pn, ps) = hosts[where[i][:1]], paths[where[i]]
        host = (a * rate + hs - e[i]) / (a + hn - 1)
        post = (b * host + ps - e[i]) / (b + pn - 1)
        odds = got[i]["p_doc"] / (1 - got[i]["p_doc"]) * post / (1 - post) / (rate / (1 - rate))
        assert got[i]["host_posterior"] == pytest.approx(host) and got[i]["path_posterior"] == pytest.approx(post)
        assert got[i]["score"] == pytest.approx(odds / (1 + odds)) and got[i]["held_out"] == held[i]
    assert got[900]["path_posterior"] == pytest.approx(rate)  # alone on its site: nothing but the global rate


def test_sparse_sites_shrink(spark):
    """A bad site with many documents pulls its members down; one document on a site of its own isn't judged by itself."""
    rows = [(i, "ab cd ef", "bad" if i < 60 else "good") for i in range(200)] + [(900, "ab cd ef", "new")]
    labels = [(i, int(i >= 60)) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in quality_scores(df, spark.createDataFrame(labels, "doc_id long, quality int"), host=F.col("source"), path=F.col("source")).collect()}
    assert max(got[i]["score"] for i in range(60)) < 0.2 < 0.6 < got[900]["score"] < min(got[i]["score"] for i in range(60, 200))


def test_noisy_or_against_plain_loops(spark):
    rnd = random.Random(24)
    bags = [[sorted(rnd.sample(range(6), rnd.randint(1, 3))) for _ in range(rnd.randint(0, 4))] for _ in range(120)]
    labels = np.array([int(any(0 in s or 1 in s for s in bag) or rnd.random() < 0.05) for bag in bags])

    def loss(theta):
        total = 0.0
        for bag, y in zip(bags, labels, strict=True):
            clean = 1 - 1 / (1 + math.exp(-theta[7]))
            for s in bag:
                clean *= 1 - 1 / (1 + math.exp(-(theta[6] + sum(theta[w] for w in s))))
            total -= math.log(max(1 - clean if y else clean, 1e-12))
        return total / len(bags) + 1e-4 * sum(t * t for t in theta[:6])

    weights, bias, leak = fit_noisy_or(bags, labels, 6, rounds=1500)
    best = [*weights, bias, math.log(leak / (1 - leak))]
    start = loss(best)
    assert start < loss([0.0] * 6 + [-3.0, -3.0]) / 2
    for k in range(8):
        for step in (-0.3, 0.3):
            moved = list(best)
            moved[k] += step
            assert loss(moved) > start - 2e-3
    model = ToxicityModel({"vile": 2.0, "mean": 1.0, "kind": -3.0}, -1.0, 0.05)
    texts = ["A vile act. Kind words! mean, VILE", "nothing here", "", None, "kind", "vile\nvile. vile"]
    got = [r["score"] for r in score_toxicity(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).orderBy("doc_id").collect()]
    for t, s in zip(texts, got, strict=True):
        assert s == pytest.approx(plain_score(t, model))


def plain_score(text, model):
    clean = 1 - model.leak
    for sentence in re.split(r"[.!?\n]+", (text or "").lower()):
        known = {w for w in re.findall(r"[^\W\d_]+", sentence) if w in model.weights}
        if known:
            clean *= 1 - 1 / (1 + math.exp(-min(30, max(-30, model.bias + sum(model.weights[w] for w in known)))))
    return 1 - clean


def test_mixing_rows_with_null_and_repeated_ids(spark):
    rows = [(None, f"w {i} " + "x " * (i % 7), "a") for i in range(300)] + [(5, f"y {i}", "b") for i in range(300)] + [(1, "z", None)]
    got = mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert got[0].asDict().keys() == {"doc_id", "size", "source_size", "target", "taken", "copies"} and list(got[0].asDict())[-1] == "copies"
    for size in {r["source_size"] for r in got}:
        mine = [r for r in got if r["source_size"] == size]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 9  # half a document or so, though ids are all alike


def test_a_filled_cache_encodes_nothing(spark, tmp_path):
    df = spark.createDataFrame([(1, "a  b"), (2, "a b"), (3, None), (None, "c")], "doc_id long, text string")
    cache = f"file://{tmp_path}/cache"
    fill_cache(df, WORD, cache)
    before = sorted(p.name for p in (tmp_path / "cache").rglob("*.parquet"))
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in token_counts(df, WORD, cache).collect()) == [(0, 1), (1, 2), (2, 2), (3, 0)]
    assert sorted(p.name for p in (tmp_path / "cache").rglob("*.parquet")) == before


def test_pipeline_against_plain_python(spark):
    sf = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{sf}/documents.parquet")
    docs = [(r["doc_id"], r["text"], r["source"]) for r in table.collect()]
    model = fit_toxicity(table, spark.read.parquet(f"{sf}/labels.parquet"))
    docs = [d for d in docs if plain_score(d[1], model) < cp.TOXIC]
    marks = [naive_fingerprint(t) for _, t, _ in docs]
    links = [(docs[a][0], docs[b][0]) for a in range(len(docs)) for b in range(a) if (marks[a] ^ marks[b]).bit_count() <= 3]
    top = forest(links + naive_pairs([d[:2] for d in docs]))
    docs = [d for d in docs if top.get(d[0], d[0]) == d[0]]
    items = [(r["item_id"], re.findall(r"[^\W_]+", r["text"].lower())) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect() if r["text"]]
    docs = [d for d in docs if not naive_items(d[1], [x for x in items if x[1]])]
    size = {d: len(re.findall(r"[^\x20\x09-\x0D]+", d[1] or "")) for d in docs}
    sources = sorted({d[2] for d in docs}, key=lambda s: (s is None, s))
    weight, full = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sources)}, {s: sum(n for d, n in size.items() if d[2] == s) for s in sources}
    capped, budget = set(), 1.5 * sum(full.values())
    while True:
        free = [s for s in sources if s not in capped]
        level = (budget - sum(2 * full[s] for s in capped)) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * full[s]}
        if not over:
            break
        capped |= over
    target = {s: 2.0 * full[s] if s in capped else level * weight[s] for s in sources}
    mixed = []
    for s in sources:
        mine = sorted((hashlib.md5(f"{d[0]}|{hashlib.md5((d[1] or '').encode()).hexdigest()}".encode()).hexdigest(), d) for d in docs if d[2] == s)
        whole = int(target[s] // full[s])
        rest, upto, more = target[s] - whole * full[s], 0, set()
        for _, d in mine:
            n = size[d]
            if upto + n <= rest or (upto <= rest and upto + n - rest < rest - upto):
                more.add(d)
            upto += n
        mixed += [d for _, d in mine for _ in range(whole + (d in more))]
    tokenizer, at, want = Tokenizer.from_file(WORD), 0, []
    for d in sorted(mixed, key=lambda d: d[0]):
        ids = np.array([*tokenizer.encode(d[1] or "", add_special_tokens=False).ids, 2], dtype="<u4")
        want.append((d[0], at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, cp.run(spark, sf).collect())) == sorted(want)
