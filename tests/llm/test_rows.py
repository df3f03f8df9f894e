"""HTML text, mixing, token tables and counts, quality and toxicity on small tables."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pluvia.llm.html_text import extract_text, render
from pluvia.llm.mixing import mix_sources, mixed_rows
from pluvia.llm.quality import host_and_path, quality_scores
from pluvia.llm.sstable import Shard, ShardWriter, key_bytes, key_id, lookup_documents, read_token_table, write_token_table
from pluvia.llm.token_counts import token_counts
from pluvia.llm import tokens
from pluvia.llm.tokens import encode, wordwise
from pluvia.llm.toxicity import fit_toxicity, score_toxicity

WORD = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string"
ODD = [None, "", " ", "<|endoftext|> a<|ENDOFTEXT|>b <|endoftext|>x.", "İstanbul ΣΑΣ Straße ﬁne éa don't I'LL 12.5% a b c\x1cx", "ab..,c d''s ''ll 's", "한국어 漢字 😀. ok", "word " * 9000, "x" * 5000]


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""), ("", ""), ("plain  text", "plain text"), ("<p>a<p>b <b>c</b>", "a\n\nb c"), ("a<br>b<br><br>c", "a\nb\n\nc"), ("<ul><li>x<li>y<ul><li>z</ul></ul>", "- x\n- y\n\n  - z"),
        ("<ol start=3><li>x<li>y</ol>", "3. x\n4. y"), ("<table><tr><th>k<th>value<tr><td>long<td>1</table>", "k     value\nlong  1"), ("<pre> a\n  b</pre>", " a\n  b"),
        ("<div hidden>no</div><p style='display: none'>no</p><script>no</script><!-- no -->yes", "yes"), ("<style>.ad, #x{display:none}</style><p class='big ad'>no</p><p id=x>no<p>yes", "yes"),
        ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a  b\n   c"), ("&lt;b&gt; &amp;", "<b> &"), ("<div>" * 3000 + "deep", "deep"), ("<blockquote>q<p>r</blockquote>s", "  q\n\n  r\n\ns"), ("<a href=x>l</a><img alt=z>m</i>", "lm"),
        ("<style>@media print{.a{display:none}}</style><p class=a>hi</p>", "hi"), ("<style>.a{display:none} .a{display:block}</style><p class=a>hi</p>", "hi"),
        ("<style>@media screen{.a{display:none}} /* .b{display:none} */ @font-face{x:y} p.c{visibility:hidden}</style><p class=a>no<p class=b>yes<p class=c>no<p id=c>too", "yes\n\ntoo"),
        ("<style>#k{display:none!important} .a{display:none}</style><p id=k style='display:block'>no</p><p class=a style='display:block'>yes</p>", "yes"),
        ("<style>@media (max-width:9px){.a{display:none}} div.a{display:none} #i{display:inline}</style><p class=a>one</p><div class=a>no</div><div class=a id=i>two</div>", "one\n\ntwo"),
        ("<table><form><tr><td>Hi<td>you</table>", "Hi  you"), ("<table><tr><form><td>a</td></form><td>b</tr></table>", "a  b"), ("<table>stray<b>bold</b><tr><td>a</table>", "straybold\n\na"),
        ("<table><div>x<tr><td>a</table>y", "x\n\na\n\ny"), ("<table><td>a<td>b<tr><td>c</table>", "a  b\nc"), ("<head><title>no</title>text<b>t</b>", "textt"), ("<head><meta x><title>no</title><a>in</a><p>p", "in\n\np"),
        ("<table><tr><td colspan=150>a<td>b<tr><td>c</table>", "a  b\nc"), ("<table><tr><td rowspan=0>a<td>b<tr><td>c<tr><td>d</table>", "a  b\n   c\n   d"), ("<table><tr><td>a<table><tr><td>i<td>j</table><td>b</table>", "a     b\n\ni  j"),
    ],
)
def test_render(html, text):
    assert render(html) == text


def test_extract_text_keeps_rows(spark):
    df = spark.createDataFrame([(1, None), (2, "<p>a</p><p>b</p>"), (2, "<p>a</p><p>b</p>"), (None, "x")], "page_id long, html string").withColumn("text", F.lit("q")).withColumn("id", F.lit(0))
    assert sorted((tuple(r) for r in extract_text(df).collect()), key=str) == sorted([(1, "", 0, 0), (2, "a\n\nb", 4, 3), (2, "a\n\nb", 4, 3), (None, "x", 1, 1)], key=str)
    assert extract_text(df.limit(0)).count() == 0


def test_mixing(spark):
    rnd = random.Random(1)
    rows = [(i, " ".join(["w"] * rnd.choice([0, 3, 50])), rnd.choice(["a"] * 6 + ["b", "c", "é", None])) for i in range(1500)]
    rows += [(7000, None, "b"), (None, "w w", "zero"), (7001, "", "empty"), (7002, "x", "c"), (7002, "x", "c")]
    df = spark.createDataFrame(rows, DOCS + ", source string").withColumn("size", F.lit(1)).withColumn("h", F.lit("")).withColumn("cut", F.lit(0)).repartition(7)
    got = mix_sources(df).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["size"] * r["copies"]
    source = {r[0]: r[2] for r in rows}
    for r in got:
        s = by.setdefault(source[r["doc_id"]], [0, 0, 0, 0.0])
        s[0] += r["size"]
        s[1] += r["taken"]
        s[2], s[3] = r["source_size"], r["target"]
    sizes = {s: v[0] for s, v in by.items()}
    assert all(v[0] == v[2] and abs(v[1] - v[3]) <= 50 for v in by.values())
    assert abs(sum(v[3] for v in by.values()) - 1.5 * sum(sizes.values())) < 1e-6 and all(v[3] <= 2 * v[0] + 1e-9 for v in by.values())
    weight = dict(zip([*sorted(s for s in sizes if s is not None), None], [3, 1, 2, 3, 1, 2, 3], strict=False))
    level = {s: v[3] / weight[s] for s, v in by.items() if v[3] < 2 * v[0] - 1e-9}
    assert len({round(x, 6) for x in level.values()}) <= 1
    again = mix_sources(df.repartition(3)).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, got), key=str)
    mixed = mixed_rows(df)
    assert mixed.columns == df.columns and mixed.count() == sum(r["copies"] for r in got)
    assert mix_sources(df.limit(0)).count() == 0


def test_encode_equals_the_library():
    tokenizer = Tokenizer.from_file(WORD)
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in ODD]
    assert [np.frombuffer(x, "<u4").tolist() for x in encode(ODD, WORD)] == want


def odd_text(rnd):
    """Words of many scripts with marks, combining signs, dotted capitals, special strings and odd spaces."""
    letters = ["abcxyz", "ABCXYZ", "éèüñßøœāğıſ", "İIŞÇĞΣ", "αβσςΣΆ", "приветЁ", "漢字かなカナ", "한국어각", "हिन्दीक़", "עברית", "ابجد", "ﬁǅǆŉªº", "e\u0301a\u0308\u0307", "0123456789", "²³½Ⅷ٣४", "'sd", "\u0130", "😀👍🏽", "\u200b\ufeff\x00\x1c\x85\xa0\u2003"]
    words = []
    for _ in range(rnd.randrange(1, 9)):
        body = "".join(rnd.choice(rnd.choice(letters) if rnd.random() < 0.2 else kind) for kind in [rnd.choice(letters)] for _ in range(rnd.randrange(1, 9)))
        words.append(rnd.choice(["", "", "", "¿", "(", "'"]) + body + "".join(rnd.choices(".,;:!?%*&$#'\"-", k=rnd.choice([0, 0, 1, 1, 2]))) + rnd.choice([""] * 30 + ["<|endoftext|>", "<|", "<|StartOfText|>"]))
    return rnd.choice([" ", " ", "\n", "  ", "\t"]).join(words)


def test_encode_equals_the_library_on_random_texts():
    rnd, tokenizer = random.Random(9), Tokenizer.from_file(WORD)
    texts = [odd_text(rnd) for _ in range(10_000)] + ["ANKARALİ, evet", "SAHİBİ.", "İ?", "क़.", "X" * 3000 + "İ."]
    for text, got in zip(texts, encode(texts, WORD), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_encode_equals_the_library_on_capitals_with_combining_marks():
    rnd, tokenizer = random.Random(10), Tokenizer.from_file(WORD)
    letters = "TJHWYtjhwyAaİıSsΩω"
    marks = [chr(c) for c in (0x300, 0x301, 0x302, 0x304, 0x307, 0x308, 0x30A, 0x30C, 0x323, 0x327, 0x331, 0x345)]
    word = lambda: "".join(rnd.choice(letters) + rnd.choice(["", *marks]) for _ in range(rnd.randrange(1, 4))) + rnd.choice(["", "", ".", "!?"])
    for text in [" ".join(word() for _ in range(rnd.randrange(1, 5))) for _ in range(5_000)] + ["T\u0308", "J\u030c x", "H\u0331.", "W\u030a Y\u030a"]:
        assert np.frombuffer(next(encode([text], WORD)), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_words_are_encoded_apart_by_what_the_file_says(tmp_path):
    assert wordwise(WORD) and not wordwise(public_tokenizers.path("byte_bpe_50k.json")) and not wordwise(public_tokenizers.path("piece_bpe_32k.model"))
    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    other.save(str(tmp_path / "word_bpe_49k.json"))
    assert not wordwise(str(tmp_path / "word_bpe_49k.json"))


def test_caches_keep_their_bounds(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 300)
    monkeypatch.setattr(tokens, "KEPT_WORDS", 100)
    monkeypatch.setattr(tokens, "CHUNK_WORDS", 50)
    rnd, tokenizer = random.Random(2), Tokenizer.from_file(WORD)
    tokens.forget()
    texts = [" ".join("".join(rnd.choices("abcdefgé", k=4)) for _ in range(40)) for _ in range(100)]
    assert [np.frombuffer(x, "<u4").tolist() for x in encode(texts, WORD)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    tokens.forget()
    assert all(len(c) <= 100 for c in tokens._words.values())


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_token_counts_and_cache(spark, tmp_path, name):
    path = public_tokenizers.path(name)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(1, ""), (None, "ab..,c d''s ''ll 's"), (90, " word  word ")]
    df = spark.createDataFrame(rows, DOCS).withColumn("content", F.lit(1)).withColumn("n_tokens", F.lit(2))
    cache = f"file://{tmp_path}/cache"
    if name.endswith(".model"):
        import sentencepiece

        count = lambda t: len(sentencepiece.SentencePieceProcessor(model_file=path).encode(t))
    else:
        tokenizer = Tokenizer.from_file(path)
        count = lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)
    want = sorted([(i, len((t or "").encode()), count(t or ""), count(t or "") > 2048) for i, t in rows], key=str)
    assert sorted((tuple(r) for r in token_counts(df, path, cache).collect()), key=str) == want
    stored = spark.read.parquet(cache).count()
    more = df.unionByName(df.limit(1).withColumn("text", F.lit("fresh text")))
    assert token_counts(more, path, cache).count() == len(rows) + 1
    assert spark.read.parquet(cache).count() == stored + 1  # only the miss was encoded
    assert token_counts(df.limit(0), path, cache).count() == 0


def test_shard_lookups_and_scan():
    keys = [None, -(2**63), -5, 0, 0, 7, 1000, 2**63 - 1]
    assert [key_id(key_bytes(k)) for k in keys] == keys and [key_bytes(k) for k in keys] == sorted(key_bytes(k) for k in keys)

    class Out(bytearray):
        write = bytearray.extend

    out = Out()
    writer = ShardWriter(out)
    data = [(key_bytes(k), np.arange(n * 9000, dtype="<u4") + 60000) for n, k in enumerate(keys)]
    for key, ids in data:
        writer.add(key, ids)
    with pytest.raises(ValueError):
        writer.add(key_bytes(3), np.zeros(1, "<u4"))
    writer.close()
    shard = Shard(lambda at, n: bytes(out[at : at + n]), len(out))
    assert len(shard.index) > 1
    assert [(k, ids.tolist()) for k, ids in shard.scan()] == [(k, ids.tolist()) for k, ids in data]
    assert [len(x) for x in shard.get(key_bytes(0))] == [3 * 9000, 4 * 9000] and shard.get(key_bytes(8)) == []
    with pytest.raises(ValueError):
        Shard(lambda at, n: bytes(out[at : at + n]), len(out) - 1)


def test_token_table_round_trip(spark):
    rows = [(i * 3 - 9, t) for i, t in enumerate(ODD)] + [(0, "dup"), (0, "dup"), (None, "none")]
    df = spark.createDataFrame(rows, DOCS).withColumn("id", F.lit(5)).withColumn("h", F.lit(6)).repartition(5)
    manifest = write_token_table(df, WORD, 2)
    tokenizer, at, want = Tokenizer.from_file(WORD), 0, []
    got = sorted((tuple(r) for r in read_token_table(manifest).collect()), key=lambda r: r[1])
    assert [r[0] is None for r in got][0] and [r[0] for r in got[1:]] == sorted(r[0] for r in rows if r[0] is not None)
    texts = {}
    for i, t in rows:
        texts.setdefault(i, []).append(np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4"))
    for i, start, n, crc in got:
        assert start == at and any(len(x) == n and zlib.crc32(x.tobytes()) == crc for x in texts[i])
        at += n
        want.append(i)
    found = lookup_documents(manifest, spark.createDataFrame([(0,), (-9,), (12345,)], "doc_id long")).collect()
    assert sorted((r["doc_id"], r["ids"]) for r in found) == sorted((i, x.tolist()) for i in (0, -9) for x in texts[i])
    empty = write_token_table(df.limit(0), WORD, 2)
    assert empty.count() == 0 and read_token_table(empty).count() == 0


def corpus(n=900):
    rnd = random.Random(4)
    vocab = ["".join(rnd.choices("abcdefgh", k=rnd.randint(2, 7))) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        toxic, junk = i % 7 == 0, i % 5 == 0
        sentences = [" ".join(rnd.choices(vocab, k=9)) + "." for _ in range(rnd.randint(1, 12))]
        if toxic:
            sentences.insert(rnd.randrange(len(sentences) + 1), f"you {rnd.choice(['villain', 'wretch'])} go.")
        text = " ".join(sentences)
        docs.append((i, " ".join(w + "%%%" for w in text.split()) if junk else text, f"s{i % 4}"))
        if i % 2 or i % 6 == 0:
            labels.append((i, int(not junk), int(toxic) if rnd.random() > 0.03 else int(not toxic)))
    return docs, labels


def test_toxicity(spark):
    docs, labels = corpus()
    rows = [*docs, (5000, None, "x"), (5001, "", "x"), (None, "wretch.", "x"), (14, docs[14][1], "s2")]
    df = spark.createDataFrame(rows, DOCS + ", source string").withColumn("score", F.lit(9)).withColumn("toxic", F.lit(1))
    lab = spark.createDataFrame([*labels, (3, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = fit_toxicity(df, lab)
    got = score_toxicity(df, model).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r["held_out"]]
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) == r["held_out"] for r in got if r["doc_id"] is not None)
    assert np.mean([r["predicted"] == (r["doc_id"] % 7 == 0) for r in held]) > 0.95
    plain = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 900 and r["doc_id"] % 35 == 7 * 3]
    assert plain and all(len(r["offending"]) == 1 and "go" in r["offending"][0]["sentence"] for r in plain)
    assert all(0 <= r["score"] <= 1 for r in got) and {r["predicted"] for r in got if r["doc_id"] in (5000, 5001)} == {0}
    blank = score_toxicity(df, fit_toxicity(df, lab.limit(0)))
    assert blank.agg(F.max("score")).first()[0] == 0.0 and score_toxicity(df.limit(0), model).count() == 0


def test_quality(spark):
    docs, labels = corpus()
    rows = [*docs, (5000, None, None), (5001, "", "rare"), (None, "a b", "x")]
    df = spark.createDataFrame(rows, DOCS + ", source string").withColumn("host", F.lit(1)).withColumn("s", F.lit("x"))
    lab = spark.createDataFrame([*labels, (3, None, None)], "doc_id long, quality int, toxic int")
    args = {"host": F.col("source"), "path": F.concat_ws("/", "source", "s")}
    got = quality_scores(df, lab, **args).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r["held_out"] and r["doc_id"] < 900]
    assert np.mean([r["kept"] == (r["doc_id"] % 5 != 0) for r in held]) > 0.95
    assert all(0 < r["path_posterior"] < 1 and 0 < r["host_posterior"] < 1 for r in got)
    assert quality_scores(df, lab.limit(0), **args).select("p_doc").distinct().collect()[0][0] == pytest.approx(0.5)
    assert quality_scores(df.limit(0), lab, **args).count() == 0
    url = spark.createDataFrame([("https://www.Shop.example.com:80/a/b?x=1",), ("http://m.x.org",), (None,)], "u string")
    host, path = host_and_path(F.col("u"))
    assert [tuple(r) for r in url.select(host, path).collect()] == [("shop.example.com", "shop.example.com/a"), ("x.org", "x.org/"), (None, None)]
