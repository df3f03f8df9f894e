"""TF-IDF by lots of documents, against plain counting."""

import math
import random
import re
from collections import Counter

import pytest

from pluvia.functions import text as tx


@pytest.fixture
def one_by_one(spark):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_large_vocabularies_need_no_exchange_of_each_documents_terms(spark, monkeypatch, one_by_one):
    monkeypatch.setattr(tx, "HELD_ROWS", 0)  # as with more terms than are broadcast
    monkeypatch.setattr(tx, "LOT_BYTES", 300, raising=False)
    rnd = random.Random(3)
    words = ["".join(rnd.choices("abcdefgh", k=rnd.randint(1, 4))) for _ in range(60)]
    docs = [(i, " ".join(rnd.choices(words, k=rnd.randint(1, 40))).replace("a", rnd.choice("aA"))) for i in range(80)]
    docs += [(5, "abc def abc"), (None, "abc def ghi"), (None, "def abc"), (90, None), (91, ""), (92, "a b c 1")]
    df = tx.tfidf(spark.createDataFrame(docs, "id long, t string"), "id", "t", min_df=3, max_df=0.4)
    assert "Join" not in df._jdf.queryExecution().executedPlan().toString()
    counts = {}
    for key, t in docs:
        found = re.findall("[a-z]{2,}", (t or "").lower())
        counts.setdefault(key, Counter()).update(found + [f"{a} {b}" for a, b in zip(found, found[1:], strict=False)])
    has = Counter(term for c in counts.values() for term in c)
    kept = {t: d for t, d in has.items() if 3 <= d <= 0.4 * len(docs)}
    want = {}
    for key, c in counts.items():
        w = {t: (1 + math.log(tf)) * (math.log((1 + len(docs)) / (1 + kept[t])) + 1) for t, tf in c.items() if t in kept}
        norm = math.sqrt(sum(x * x for x in w.values()))
        want |= {(key, t): x / norm for t, x in w.items()}
    got = {(r["id"], r["term"]): r["weight"] for r in df.collect()}
    assert got.keys() == want.keys() and len(got) == df.count() > 500
    assert all(math.isclose(got[x], want[x], rel_tol=1e-12) for x in want)
