"""Toxicity by multiple-instance learning: sentence scores, joined by noisy-or, learnt from document labels."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvia.llm.common import give_back, ids_for_python, ids_from_python, lean, saved

_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")


@dataclass
class ToxicityModel:
    """Weights of the words that tell, the bias of a sentence that has one, and the leak: what no sentence explains."""

    weights: dict[str, float]
    bias: float
    leak: float

    def sentences(self, text: str | None) -> list[tuple[int, int, float]]:
        """(start, end, probability) of each sentence that holds a telling word; others have probability 0."""
        low = (text or "").lower()
        if self.weights.keys().isdisjoint(_WORD.findall(low)):
            return []
        out = []
        # some letters change length in lower case; spans then refer to the lower-case text
        for m in _SENTENCE.finditer(low):
            known = [self.weights[w] for w in set(_WORD.findall(m[0])) if w in self.weights]
            if known:
                z = self.bias + sum(known)
                out.append((m.start(), m.end(), float(1 / (1 + np.exp(-np.clip(z, -30, 30))))))
        return out

    def score(self, found: list[tuple[int, int, float]]) -> float:
        clean = 1.0 - self.leak
        for *_, p in found:
            clean *= 1.0 - p
        return min(1.0, max(0.0, 1.0 - clean))


def held_out(id_col: str = "doc_id"):
    """True for rows that no model may learn from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [(w, int(y)) for t, y in zip(batch["text"], batch["toxic"], strict=True) for w in set(_WORD.findall((t or "").lower()))]
        yield pd.DataFrame(rows, columns=["word", "toxic"]).groupby("word")["toxic"].agg(["count", "sum"]).reset_index().set_axis(["word", "n", "k"], axis=1)


def _bags(place: dict[str, int]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                bag = []
                for m in _SENTENCE.finditer((text or "").lower()):
                    ids = sorted({place[w] for w in _WORD.findall(m[0]) if w in place})
                    if ids:
                        bag.append(ids)
                out.append((int(toxic), bag))
            yield pd.DataFrame(out, columns=["toxic", "bag"])

    return run


def fit_noisy_or(bags: list[list[list[int]]], labels: np.ndarray, n_words: int, rounds: int = 400, rate: float = 0.1, ridge: float = 2e-4):
    """Maximises the likelihood of bag labels under 1 - (1 - leak) * product(1 - p(sentence)), by Adam."""
    sent_bag = np.array([b for b, bag in enumerate(bags) for _ in bag], dtype=int)
    words = [ids for bag in bags for ids in bag]
    row = np.repeat(np.arange(len(words)), [len(x) for x in words]) if words else np.zeros(0, int)
    col = np.concatenate([np.asarray(x, int) for x in words]) if words else np.zeros(0, int)
    theta = np.zeros(n_words + 2)
    theta[-2], theta[-1] = -3.0, -3.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        z = theta[-2] + np.bincount(row, theta[col], len(words))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        leak = 1 / (1 + np.exp(-theta[-1]))
        log_clean = np.log1p(-leak) + np.bincount(sent_bag, np.log1p(-np.minimum(p, 1 - 1e-9)), len(bags))
        dirty = np.maximum(-np.expm1(log_clean), 1e-9)
        up = np.where(labels == 1, np.exp(log_clean) / dirty, -1.0)  # of the log likelihood, by -log_clean
        g_sent = up[sent_bag] * p
        grad = np.concatenate([np.bincount(col, g_sent[row], n_words), [g_sent.sum(), (up * leak).sum()]])
        grad = -grad / len(bags)
        grad[:n_words] += ridge * theta[:n_words]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return theta[:n_words], float(theta[-2]), float(1 / (1 + np.exp(-theta[-1])))


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    max_rows: int = 20_000, max_words: int = 4096, min_docs: int = 5, min_chi2: float = 25.0,
) -> ToxicityModel:
    """Learns from at most `max_rows` labelled documents outside the held-out fold, the first by hash of the id.

    Words enter the model if they are in `min_docs` of these documents and depend on the label (chi-square at least
    `min_chi2`, the `max_words` strongest). Their counts are made by Spark; the driver gets the sentences' word
    numbers of the bounded sample only. Equal texts count once, toxic if any copy is. Null labels are ignored; without any
    usable label the model scores every document 0.
    """
    usable = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    ids = usable.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
    chosen = F.broadcast(saved(ids.orderBy(F.xxhash64("id"), "id").limit(max_rows), "label-sample"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(chosen, "id")
    sample = saved(rows.groupBy("text").agg(F.max("toxic").alias("toxic")), "train")
    total = sample.agg(F.count("*"), F.sum("toxic")).first()
    n, k = total[0], total[1] or 0
    if not n or not k or n == k:
        return ToxicityModel({}, -10.0, float(k / n) if n else 0.0)
    counts = sample.mapInPandas(lean(_words), "word string, n long, k long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    w, y = F.col("n").cast("double"), F.col("k").cast("double")
    gap = (y * n - w * k) ** 2 * n / (w * (n - w) * k * (n - k))
    strong = counts.where((w >= min_docs) & (w < n)).withColumn("chi2", gap).where(F.col("chi2") >= min_chi2)
    words = [r["word"] for r in strong.orderBy(F.desc("chi2"), "word").limit(max_words).collect()]
    got = sample.mapInPandas(lean(_bags({w: i for i, w in enumerate(words)})), "toxic int, bag array<array<int>>").collect()
    got.sort(key=lambda r: (r["toxic"], r["bag"]))
    weights, bias, leak = fit_noisy_or([r["bag"] for r in got], np.array([r["toxic"] for r in got]), len(words))
    return ToxicityModel(dict(zip(words, weights.tolist(), strict=True)), bias, leak)


def toxicity_of(text_col: str, model: ToxicityModel):
    """The score of each text as a column, for filters that keep a table's other columns."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([model.score(model.sentences(t)) for t in texts], dtype="float64")
        give_back()

    return score(F.col(text_col))


_SPANS = "array<struct<start:int,end:int,p:double,sentence:string>>"


def _score(model: ToxicityModel, least: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores, spans = [], []
            for text in batch["text"]:
                found = model.sentences(text)
                scores.append(model.score(found))
                low = (text or "").lower()
                whole = text if len(low) == len(text or "") else low
                spans.append([{"start": s, "end": e, "p": p, "sentence": whole[s:e].strip()} for s, e, p in found if p >= least])
            yield batch[["id", "id_none"]].assign(score=scores, offending=spans)

    return run


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3
) -> DataFrame:
    """One row per input row: id, held_out, score (0 to 1), predicted (1 if score >= threshold), offending.

    offending lists the sentences whose own probability reaches the threshold: start, end, p, sentence. A text
    without telling words, empty or null gets the model's leak. Repeated rows and null ids keep their rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    scored = ids_from_python(ids_for_python(rows).mapInPandas(lean(_score(model, threshold)), f"id {kind}, id_none boolean, score double, offending {_SPANS}"))
    return scored.select(
        F.col("id").alias(id_col), held_out("id").alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"), "offending",
    )
