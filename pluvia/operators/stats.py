"""Association, outliers and rank tests."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvia.operators.events import _corr, average_rank
from pluvia.operators.kd import nearest_by_parts
from pluvia.operators.ranks import counted, quantiles
from pluvia.sources.rounds import settled


def cramers_v(df: DataFrame, a: str, b: str) -> DataFrame:
    """Bias-corrected Cramér's V of two columns on rows that have both; null if a side has fewer than two levels.

    Chi-square comes from the contingency counts and their margins, never from the rows again.
    """
    cells = df.dropna(subset=[a, b]).groupBy(F.col(a).alias("_a"), F.col(b).alias("_b")).agg(F.count("*").cast("double").alias("o"))
    rows = cells.groupBy("_a").agg(F.sum("o").alias("ra"))
    cols = cells.groupBy("_b").agg(F.sum("o").alias("rb"))
    total = cells.agg(F.sum("o").alias("n"), F.count_distinct(F.col("_a")).alias("r"), F.count_distinct(F.col("_b")).alias("k"))
    # sum of o^2 / (ra * rb) - 1 is chi-square / n, empty cells included
    phi = cells.join(rows, "_a").join(cols, "_b").agg((F.sum(F.col("o") * F.col("o") / (F.col("ra") * F.col("rb"))) - 1).alias("phi2"))
    one = total.join(phi, how="cross")
    less = (F.col("r") - 1) * (F.col("k") - 1) / (F.col("n") - 1)
    phi2 = F.greatest(F.lit(0.0), F.col("phi2") - less)
    side = lambda x: F.col(x) - (F.col(x) - 1) * (F.col(x) - 1) / (F.col("n") - 1)
    v = F.sqrt(F.try_divide(phi2, F.least(side("r"), side("k")) - 1))
    return one.select(F.lit(a).alias("a"), F.lit(b).alias("b"), F.when((F.col("r") > 1) & (F.col("k") > 1) & (F.col("n") > 1), v).alias("v"))


def cramers_v_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    return reduce(DataFrame.unionByName, [cramers_v(df, a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]])


def correlation_ratio(df: DataFrame, cat: str, num: str) -> DataFrame:
    """eta: root of between-group over total sum of squares, null if the total is 0."""
    groups = df.dropna(subset=[cat, num]).groupBy(cat).agg(F.count("*").alias("n"), F.avg(num).alias("m"), F.var_pop(num).alias("v"))
    total = groups.agg(F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("mean"))
    both = groups.join(F.broadcast(total.select("mean")), how="cross")
    sums = both.agg(F.sum(F.col("n") * (F.col("m") - F.col("mean")) ** 2).alias("between"), F.sum(F.col("n") * F.col("v")).alias("within"))
    return sums.select(F.sqrt(F.try_divide(F.col("between"), F.col("between") + F.col("within"))).alias("eta"))


def iqr_outliers(df: DataFrame, col: str, k: float = 1.5, high_only: bool = False) -> DataFrame:
    """Adds outlier: outside Q1 - k IQR .. Q3 + k IQR (linear quantiles). Nulls are no outliers."""
    low, top = quantiles(df, col, [0.25, 0.75])
    if low is None:
        return df.withColumn("outlier", F.lit(False))
    high = F.col(col) > top + k * (top - low)
    flag = high if high_only else high | (F.col(col) < low - k * (top - low))
    return df.withColumn("outlier", F.coalesce(flag, F.lit(False)))


def _above(scored: DataFrame, key: str, share: float) -> DataFrame:
    """(key, score, outlier): flagged above the quantile. The scores are fixed first, as they are read twice."""
    scored = settled(scored)
    cut = quantiles(scored, "score", [share])[0]
    return scored.select(key, "score", (F.col("score") > cut if cut is not None else F.lit(None).cast("boolean")).alias("outlier"))


def pearson_log(df: DataFrame, cols: list[str], strong: float = 0.6) -> DataFrame:
    """Pearson correlation of raw and log1p values for every pair of columns in one pass, with a flag for |r| >= strong."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]
    both = lambda a, b, f: [f(F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), F.col(x))) for x, y in ((a, b), (b, a))]
    same = lambda c: c.cast("double")
    wide = df.select(*[x.alias(f"{kind}{side}{i}") for i, (a, b) in enumerate(pairs) for kind, f in (("p", same), ("l", lambda c: F.log1p(c))) for side, x in zip("xy", both(a, b, f), strict=True)])
    sums = wide.agg(*[_corr(f"{kind}x{i}", f"{kind}y{i}").alias(f"{kind}{i}") for i in range(len(pairs)) for kind in "pl"])
    rows = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"p{i}").alias("r"), F.col(f"l{i}").alias("r_log")) for i, (a, b) in enumerate(pairs)])
    return sums.select(F.explode(rows).alias("x")).select("x.*").withColumn("strong", F.coalesce(F.abs("r_log") >= strong, F.lit(False)))


def ecod(df: DataFrame, key: str, cols: list[str], contamination: float = 0.02) -> DataFrame:
    """(key, score, outlier): sum over columns of the larger of the two minus log empirical tail probabilities, flagged
    above the (1 - contamination) quantile. The tail that the skewness points to is one of the two, so the larger
    covers it. Tails come from counts per distinct value, summed by ranges of values: no task sees a whole column.
    """
    rows = df.select(key, *cols).dropna(subset=cols)
    total, out = rows.count(), rows
    for i, c in enumerate(cols):
        upto = F.col("_below") + F.col("_n")
        out = out.join(counted(rows, c).select(c, F.least(upto, total - F.col("_below")).alias(f"_t{i}")), c)
    score = reduce(lambda a, b: a + b, [-F.log(F.col(f"_t{i}") / F.lit(total)) for i in range(len(cols))])
    return _above(out.select(key, score.alias("score")), key, 1 - contamination)


def _grow(x: np.ndarray, depth: int, rng) -> list:
    """Isolation tree as [column, cut, left, right], or [size] as a leaf."""
    if depth == 0 or len(x) < 2 or (x.max(axis=0) == x.min(axis=0)).all():
        return [len(x)]
    wide = np.flatnonzero(x.max(axis=0) > x.min(axis=0))
    c = int(rng.choice(wide))
    cut = float(rng.uniform(x[:, c].min(), x[:, c].max()))
    left = x[:, c] < cut
    return [c, cut, _grow(x[left], depth - 1, rng), _grow(x[~left], depth - 1, rng)]


def _path(n) -> np.ndarray:
    """Mean path length of an unsuccessful search among n points."""
    n = np.maximum(np.asarray(n, dtype=float), 1)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / n, np.where(n == 2, 1.0, 0.0))


def _depths(tree: list, x: np.ndarray) -> np.ndarray:
    out, todo = np.zeros(len(x)), [(tree, np.arange(len(x)), 0)]
    while todo:
        node, rows, depth = todo.pop()
        if len(node) == 1:
            out[rows] = depth + _path(node[0])
            continue
        left = x[rows, node[0]] < node[1]
        todo += [(node[2], rows[left], depth + 1), (node[3], rows[~left], depth + 1)]
    return out


def isolation_forest(df: DataFrame, key: str, cols: list[str], contamination: float = 0.02, trees: int = 100, sample: int = 256, seed: int = 42) -> DataFrame:
    """(key, score, outlier). Each tree grows on a sample of at most `sample` rows, drawn by hash, in its own task; the
    forest (trees x sample nodes at most) is what reaches the driver, and rows are scored in Arrow batches."""
    import json

    rows = df.select(key, *[F.col(c).cast("double").alias(c) for c in cols]).dropna(subset=cols)
    n = rows.count()
    share = min(1.0, 4.0 * sample / max(n, 1))
    drawn = rows.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).withColumn("h", F.pmod(F.xxhash64(F.lit(seed), "tree", key), F.lit(1 << 30)))
    drawn = drawn.where(F.col("h") < int(share * (1 << 30)))

    def fit(tree_key, pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values(["h", key]).head(sample)[cols].to_numpy()
        depth = int(np.ceil(np.log2(max(len(x), 2))))
        return pd.DataFrame({"tree": [int(tree_key[0])], "size": [len(x)], "nodes": [json.dumps(_grow(x, depth, np.random.default_rng([seed, int(tree_key[0])])))]})

    forest = [(json.loads(r["nodes"]), r["size"]) for r in drawn.groupBy("tree").applyInPandas(fit, "tree int, size int, nodes string").orderBy("tree").collect()]
    norm = float(np.mean(_path([s for _, s in forest]))) if forest else 1.0

    @F.pandas_udf("double")
    def score(*values: pd.Series) -> pd.Series:
        x = np.column_stack([v.to_numpy(dtype=float) for v in values])
        return pd.Series(2 ** (-np.mean([_depths(t, x) for t, _ in forest], axis=0) / (norm or 1.0)))

    return _above(rows.select(key, score(*cols).alias("score")), key, 1 - contamination)


def neighbours(df: DataFrame, key: str, cols: list[str], k: int) -> DataFrame:
    """Exact k nearest rows of each row by the Euclidean distance of `cols`: (key, other, d, r), ties by key. Rows with a value that is null or not
    finite are left out. Space is parted where rows are dense; of rows at one place only the k + 1 smallest keys are searched."""
    rows = df.select(F.col(key), *[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(cols)]).where(" and ".join(f"abs(v{i}) < 1e150" for i in range(len(cols))))
    others = rows.select(F.col(key).alias("other"), *[F.col(f"v{i}").alias(f"ov{i}") for i in range(len(cols))])
    square = reduce(lambda a, b: a + b, [(F.col(f"v{i}") - F.col(f"ov{i}")) * (F.col(f"v{i}") - F.col(f"ov{i}")) for i in range(len(cols))])
    return nearest_by_parts(rows, key, others, "other", [(f"v{i}",) for i in range(len(cols))], F.sqrt(square), k, apart=F.col(key) != F.col("other"))


def lof(neighbours: DataFrame, key: str, contamination: float = 0.02) -> DataFrame:
    """(key, score, outlier) from a table of k nearest neighbours (key, other, d, r): k-distance, reachability density and its
    ratio to the neighbours' density, as joins. Duplicated points get a floor of 1e-10 on distances, as usual."""
    neighbours = settled(neighbours)  # read three times
    kdist = neighbours.groupBy(F.col(key).alias("other")).agg(F.max("d").alias("_kd"))
    reach = neighbours.join(kdist, "other").withColumn("_rd", F.greatest("d", "_kd"))
    lrd = reach.groupBy(key).agg((1 / (F.avg("_rd") + 1e-10)).alias("lrd"))
    other = lrd.select(F.col(key).alias("other"), F.col("lrd").alias("_ol"))
    scored = neighbours.join(other, "other").groupBy(key).agg(F.avg("_ol").alias("_m")).join(lrd, key).select(key, (F.col("_m") / F.col("lrd")).alias("score"))
    return _above(scored, key, 1 - contamination)


def outlier_votes(df: DataFrame, flags: list[str]) -> DataFrame:
    """Adds votes: how many detectors flag the row (null counts as no)."""
    return df.withColumn("votes", reduce(lambda a, b: a + b, [F.coalesce(F.col(c).cast("int"), F.lit(0)) for c in flags]))


def vote_lift(df: DataFrame, votes: Column, flag: Column) -> DataFrame:
    """Rows, rows with two votes or more, their rate of `flag`, the base rate, and the lift."""
    f = flag.cast("double")
    got = df.agg(F.count("*").alias("rows"), F.count_if(votes >= 2).alias("voted"), F.avg(F.when(votes >= 2, f)).alias("rate"), F.avg(f).alias("base"))
    return got.withColumn("lift", F.try_divide("rate", "base"))


def kruskal_wallis(df: DataFrame, group: str, col: str) -> DataFrame:
    """H with tie correction, degrees of freedom and p (chi-square tail, by series)."""
    ranked = average_rank(df.dropna(subset=[group, col]).select(group, F.col(col).alias("_v")), "_v", None, "_r")
    per = ranked.groupBy(group).agg(F.count("*").alias("n"), F.sum("_r").alias("s"))
    base = per.agg(F.sum("n").cast("double").alias("n"), F.sum(F.col("s") * F.col("s") / F.col("n")).alias("q"), (F.count("*") - 1).alias("df"))
    ties = ranked.groupBy("_v").agg(F.count("*").cast("double").alias("t")).agg(F.sum(F.col("t") ** 3 - F.col("t")).alias("ties"))
    n = F.col("n")
    h = F.try_divide(12 / (n * (n + 1)) * F.col("q") - 3 * (n + 1), 1 - F.col("ties") / (n**3 - n))
    return base.join(ties, how="cross").select(h.alias("h"), F.col("df").cast("long").alias("df")).withColumn("p", chi2_tail(F.col("h"), F.col("df")))


def chi2_tail(x: Column, df: Column, terms: int = 200) -> Column:
    """Upper tail of the chi-square law: 1 - gamma series of the lower incomplete gamma function, on one row."""
    a, z = df / 2.0, x / 2.0
    # sum of z^i / (a (a + 1) ... (a + i))
    series = F.aggregate(F.sequence(F.lit(1), F.lit(terms)), F.struct((1.0 / a).alias("t"), (1.0 / a).alias("s")), lambda acc, i: F.struct((acc["t"] * z / (a + i)).alias("t"), (acc["s"] + acc["t"] * z / (a + i)).alias("s")))["s"]
    return F.when(x.isNotNull(), F.greatest(F.lit(0.0), 1 - F.exp(-z + a * F.log(z) - log_gamma(a)) * series))


def log_gamma(a: Column) -> Column:
    """Stirling's series after shifting the argument by 8."""
    shifted = a + 8
    shift = reduce(lambda p, q: p * q, [a + i for i in range(8)])
    return (shifted - 0.5) * F.log(shifted) - shifted + 0.9189385332046727 + 1 / (12 * shifted) - 1 / (360 * shifted**3) - F.log(shift)
