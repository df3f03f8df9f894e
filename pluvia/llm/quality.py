"""Document quality: classifier evidence joined with empirical-Bayes posteriors of host and path."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvia.llm.common import ids_for_python, ids_from_python, lean, saved, small
from pluvia.llm.toxicity import held_out

FEATURES = ("log_words", "word_length", "symbols", "upper", "digits", "odd_words", "bars", "distinct", "top_word", "repeated_lines", "line_length", "stops")
# byte classes: 0 space, 1 small or not ASCII, 2 capital, 3 digit, 4 plain mark, 5 other mark
_CLASS = np.ones(256, dtype="uint8")
_CLASS[:128] = [0 if c in " \t\n\r\x0b\x0c" else 1 if c.islower() else 2 if c.isupper() else 3 if c.isdigit() else 4 if c in ".,;:'\"()-" else 5 for c in map(chr, range(128))]


def features(text: str | None) -> list[float]:
    """Shape of a whole text; all zero where there are no words. No word lists: nothing depends on the language."""
    data = (text or "").encode()
    words = data.split()
    if not words:
        return [0.0] * len(FEATURES)
    kind = _CLASS[np.frombuffer(data, dtype="uint8")]
    inside = np.r_[False, kind > 0, False]
    starts, ends = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])

    def per_word(c: int) -> np.ndarray:
        total = np.r_[0, np.cumsum(kind == c, dtype="int32")]
        return total[ends] - total[starts]

    small, capital, digit, mark = per_word(1), per_word(2), per_word(3), per_word(5)
    n, length, counts = len(starts), ends - starts, Counter(words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    return [
        float(np.log1p(n)), float(length.mean()), float(mark.sum() / len(data)), float(((capital > 1) & (small == 0)).mean()), float((digit > 0).mean()),
        float(((mark > 0) | (digit > 0) | (small + capital == 0)).mean()), counts.get(b"|", 0) / n, len(counts) / n, max(counts.values()) / n,
        1 - len(set(lines)) / len(lines), float(np.log1p(n / len(lines))), float((length <= 3).mean()),
    ]


def _shapes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"row": batch["row"], "label": batch["label"], "x": [features(t) for t in batch["text"]]})


def _evidence(beta: np.ndarray, mean: np.ndarray, scale: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = (np.array([features(t) for t in batch["text"]]).reshape(-1, len(FEATURES)) - mean) / scale
            z = beta[0] + x @ beta[1 : len(FEATURES) + 1] + x**2 @ beta[len(FEATURES) + 1 :]
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield batch[["id", "id_none", "host", "path"]].assign(p_doc=p)

    return run


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Ridge logistic regression on x and x squared by Newton steps; the intercept isn't shrunk."""
    a = np.hstack([np.ones((len(x), 1)), x, x**2])
    beta, shrink = np.zeros(a.shape[1]), ridge * np.eye(a.shape[1])
    shrink[0, 0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        hess = (a * (p * (1 - p))[:, None]).T @ a + shrink
        step = np.linalg.solve(hess, a.T @ (y - p) - shrink @ beta)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return beta


def fit_evidence(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_rows: int):
    """Coefficients, means and scales, fitted on at most `max_rows` labelled documents outside the held-out fold."""
    usable = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    ids = usable.groupBy(F.col(id_col).alias("row")).agg(F.min(F.col(label_col).cast("int")).alias("label"))
    chosen = F.broadcast(saved(ids.orderBy(F.xxhash64("row"), "row").limit(max_rows), "label-sample"))
    rows = docs.select(F.col(id_col).alias("row"), F.col(text_col).alias("text")).join(chosen, "row")
    got = rows.mapInPandas(_shapes, "row long, label int, x array<double>").collect()
    got.sort(key=lambda r: (r["row"], r["x"]))
    n = len(FEATURES)
    x, y = np.array([r["x"] for r in got]).reshape(-1, n), np.array([r["label"] for r in got], dtype=float)
    if not len(y) or y.min() == y.max():
        return np.r_[np.log((y.sum() + 1) / (len(y) - y.sum() + 1)), np.zeros(2 * n)], np.zeros(n), np.ones(n)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    return fit_logistic((x - mean) / scale, y), mean, scale


def _strength(groups: DataFrame, center: Column) -> float:
    """Prior strength of a beta law by the method of moments: groups (n, s, s2) around their center, kept in 1 to 1e6."""
    rate = F.col("s") / F.col("n")
    got = groups.where("n > 1").agg(
        F.sum(F.col("n") * (rate - center) ** 2), F.sum(F.col("n") * center * (1 - center)), F.count("*"), F.sum("n")
    ).first()
    between, binomial, count, n = (float(v or 0) for v in got)
    if not count or not binomial or n <= count:
        return 1e6
    # weighted variance of rates = m(1-m) * (1 + (n - 1) / (strength + 1)) / n, summed over groups
    excess = between / binomial * n / count - 1
    return float(np.clip((n / count - 1) / excess - 1 if excess > 0 else 1e6, 1.0, 1e6))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host of a URL in lower case without www, m or port, and host plus first path segment."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, r"^[a-zA-Z]+://([^/?#:]+)", 1)), r"^(www|m)[.]", "")
    return host, F.concat(host, F.lit("/"), F.regexp_extract(url, r"^[a-zA-Z]+://[^/?#]+/([^/?#]*)", 1))


def quality_scores(
    docs: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", max_rows: int = 20_000, threshold: float = 0.5,
) -> DataFrame:
    """One row per input row: id, held_out, p_doc, host_posterior, path_posterior, score, kept.

    p_doc is a logistic classifier on the shape of the whole text. A host's evidence is the sum of its documents'
    labels, where known outside the held-out fold, else of their p_doc. It is shrunk to the global rate by a beta prior whose
    strength comes from the spread of hosts (method of moments); a path is shrunk to its host the same way. A document's own
    evidence is left out of its host's and path's posterior: a document alone on its site gets the global rate. The score
    multiplies the odds of p_doc by the odds of the path against the global odds. Groups are sums per host
    and path, combined before the shuffle; only the fitted sample (at most `max_rows`) and a few sums reach the driver.

    Null host or path form one group each. Null or empty text: all features zero. Repeated rows and null ids keep
    their rows. Without labels p_doc is one half. Empty input: no rows.
    """
    beta, mean, scale = fit_evidence(docs, labels, id_col, text_col, label_col, max_rows)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), host.cast("string").alias("host"), path.cast("string").alias("path"))
    judged = ids_for_python(rows).mapInPandas(lean(_evidence(beta, mean, scale)), "id long, id_none boolean, host string, path string, p_doc double")
    judged = saved(ids_from_python(judged), "evidence")
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min(F.col(label_col).cast("double")).alias("y"))
    soft = judged.join(small(saved(known, "known")), "id", "left").withColumn("e", F.coalesce("y", "p_doc"))
    paths = saved(soft.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("e").alias("s")), "paths")
    hosts = saved(paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s")), "hosts")
    n, s = hosts.agg(F.sum("n"), F.sum("s")).first()
    rate = min(max((s or 0.0) / n, 1e-6), 1 - 1e-6) if n else 0.5
    a = _strength(hosts, F.lit(rate))
    hosts = hosts.select(F.col("host").alias("h"), F.col("n").alias("host_n"), F.col("s").alias("host_s"))
    paths = saved(paths.join(hosts, F.col("host").eqNullSafe(F.col("h"))).drop("h"), "path-sums")
    b = _strength(paths, (F.lit(a * rate) + F.col("host_s")) / (F.lit(a) + F.col("host_n")))
    sums = paths.select(F.col("host").alias("h"), F.col("path").alias("q"), "n", "s", "host_n", "host_s")
    both = soft.join(small(sums), F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("q")))
    # all that others say: the document's own evidence comes in once, through p_doc
    host_post = (F.lit(a * rate) + F.col("host_s") - F.col("e")) / (F.lit(a) + F.col("host_n") - 1)
    path_post = (F.lit(b) * F.col("host_posterior") + F.col("s") - F.col("e")) / (F.lit(b) + F.col("n") - 1)
    both = both.withColumn("host_posterior", _unit(host_post)).withColumn("path_posterior", _unit(path_post))
    odds = lambda p: F.least(F.greatest(p, F.lit(1e-9)), F.lit(1 - 1e-9)) / (1 - F.least(F.greatest(p, F.lit(1e-9)), F.lit(1 - 1e-9)))
    joint = odds(F.col("p_doc")) * odds(F.col("path_posterior")) / F.lit(rate / (1 - rate))
    return both.select(
        F.col("id").alias(id_col), held_out("id").alias("held_out"), "p_doc", "host_posterior", "path_posterior",
        (joint / (1 + joint)).alias("score"), (joint / (1 + joint) >= threshold).alias("kept"),
    )


def _unit(p: Column) -> Column:
    """Sums of doubles may pass the ends by a rounding error."""
    return F.greatest(F.lit(1e-9), F.least(F.lit(1 - 1e-9), p))
