"""Quality classifier with hierarchical empirical Bayes over hosts and paths.

Document evidence.  A logistic regression on measurements of the text (shares of symbols, capitals,
repeated windows and lines, letters, ...) is fitted on a bounded sample of labelled rows.  Its log-odds
less those of the sample's share of good documents are the log likelihood ratio of a document.

Sites.  Every document, labelled or not, adds its probability of being good to its path (here:
source and language) and its host (here: source).  Grouped sums give, level by level,

    host = (a * all + good documents of the host) / (a + documents of the host)
    path = (b * host + good documents of the path) / (b + documents of the path)

where the weights a and b, the numbers of documents that the level above is worth, come from the spread of the sites
by the method of moments.  A sparse site is so drawn to its host, and a sparse host to the whole.
A document's own part is taken out of its path before the path becomes its prior, so
nothing counts twice.  The document's log-odds are those of its path plus its log likelihood ratio.

Sums are of probabilities in millionths, as integers: reruns agree to the last bit.  The driver gets
the sample's measurements (``most_labels`` rows of numbers) and a few totals; a hot host is summed
map-side first.

Edge cases: a null or empty text is scored from measurements of 0; null hosts and paths are sites of
their own; without labelled rows of both classes every document has a likelihood ratio of 1 and is kept; repeated
rows are scored one by one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded, documents, map_texts, sampled_labels, saved, text_key, without
from .quality_rules import MEASURES, measure
from .registry import query

MILLION = 1_000_000


def features(text: str | None) -> list[float]:
    """Numbers of a text that don't grow with its length, and a 1 for the intercept."""
    m = dict(zip(MEASURES, measure(text), strict=True))
    words, lines = max(1, m["n_words"]), max(1, m["n_lines"])
    letters = max(1, m["n_upper"] + m["n_lower"])
    marks = 0 if text is None else text.count("!") + text.count("?")
    pipes = 0 if text is None else text.count("|")
    return [1.0, min(1.0, m["n_symbols"] / words), min(1.0, pipes / words), m["n_upper"] / letters, m["n_repeat_words"] / words,
            m["n_dup_lines"] / lines, 1.0 - m["n_letter_words"] / words, min(1.0, marks / words), min(20.0, m["word_chars"] / words) / 20.0]


N_FEATURES = len(features(""))


def fit(x: np.ndarray, y: np.ndarray, l2: float = 0.5, rounds: int = 40) -> np.ndarray:
    """Logistic regression by Newton's method; the intercept is not penalised."""
    beta = np.zeros(x.shape[1])
    penalty = np.diag([1e-6] + [l2] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ beta)
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    return beta


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality",
          most_labels: int = 10_000) -> tuple[np.ndarray, float]:
    """Weights and the share of good documents, from at most ``most_labels`` labelled rows."""
    chosen = sampled_labels(labels, label, most_labels, id_col)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(chosen), "_id")
    rows = map_texts(texts, "_text", lambda t: [pa.array([features(x) for x in t], pa.list_(pa.float64()))], "x array<double>", ["_id", "_label"])
    found = sorted((r["_id"], r["_label"], r["x"]) for r in rows.collect())
    y = np.array([label for _, label, _ in found], np.float64)
    if not 0 < y.sum() < len(y):
        return np.zeros(N_FEATURES), 0.9
    x = np.array([x for _, _, x in found])
    return fit(x, y), float(y.mean())


def evidence(docs: DataFrame, weights: np.ndarray, share: float, text_col: str, keep: list[str], most: float = 12.0) -> DataFrame:
    """The columns ``keep`` and _llr, the log likelihood ratio of each row (within +-``most``)."""
    prior = float(np.log(share / (1 - share))) if np.any(weights) else 0.0

    def run(texts):
        x = np.array([features(t) for t in texts]).reshape(len(texts), N_FEATURES)
        return [pa.array(np.clip(np.round(x @ weights - prior, 9), -most, most), pa.float64())]

    return map_texts(docs, text_col, run, "_llr double", keep)


def _odds(p: Column) -> Column:
    return F.log(p / (1 - p))


def _worth(sites: DataFrame, n: str, good: str, above: Column) -> float:
    """a of the level: sites' shares vary by m (1 - m) / n for chance alone; what they vary beyond that is the spread
    t of the sites, and a = m (1 - m) / t - 1, held between 1 and 10,000."""
    share = F.col(good) / F.col(n) / MILLION
    chance = above * (1 - above)
    r = sites.filter(F.col(n) > 1).agg(F.sum(F.floor(F.col(n) * (share - above) ** 2 * MILLION)).alias("v"), F.sum(F.floor(chance * MILLION)).alias("c"),
                                       F.sum(n).alias("n"), F.sum(F.floor(F.col(n) * chance * MILLION)).alias("w")).first()
    if not r["n"] or not r["w"]:
        return 10_000.0
    spread = (r["v"] - r["c"]) / MILLION / r["n"]
    return float(min(10_000.0, max(1.0, r["w"] / MILLION / r["n"] / spread - 1))) if spread > 0 else 10_000.0


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host: Column | None = None,
          path: Column | None = None, most_labels: int = 10_000, threshold: float = 0.5) -> DataFrame:
    """``id_col``, _t (text key), evidence, site_prior, score (probability of being good) and kept, for every row."""
    host = F.col("source") if host is None else host
    path = F.col("lang") if path is None else path
    weights, share = train(docs, labels, id_col, text_col, "quality", most_labels)
    keys = docs.select(F.col(id_col).alias("_id"), text_key(F.col(text_col)).alias("_t"), host.cast("string").alias("_host"), path.cast("string").alias("_path"),
                       F.col(text_col).alias("_text"))
    scored = evidence(keys, weights, share, "_text", ["_id", "_t", "_host", "_path"])
    good = 1 / (1 + F.exp(-(F.col("_llr") + F.lit(float(np.log(share / (1 - share)))))))
    scored = saved(scored.withColumn("_good", F.round(good * MILLION).cast("long")))

    paths = saved(scored.groupBy("_host", "_path").agg(F.count(F.lit(1)).alias("_n"), F.sum("_good").alias("_g")))
    total = paths.agg(F.sum("_n").alias("n"), F.sum("_g").alias("g")).first()
    # a share of 0 or 1 would rule out all else
    mean = min(0.999, max(0.001, (total["g"] or 0) / MILLION / total["n"])) if total["n"] else 0.5
    hosts = paths.groupBy("_host").agg(F.sum("_n").alias("_hn"), F.sum("_g").alias("_hg"))
    a = _worth(hosts, "_hn", "_hg", F.lit(mean))
    hosts = hosts.withColumn("_hm", (a * mean + F.col("_hg") / MILLION) / (a + F.col("_hn")))
    sites = saved(paths.join(hosts.withColumnRenamed("_host", "_h"), F.col("_host").eqNullSafe(F.col("_h"))).select("_host", "_path", "_n", "_g", "_hm"))
    b = _worth(sites, "_n", "_g", F.col("_hm"))
    sites = sites.select(F.col("_host").alias("_h"), F.col("_path").alias("_p"), "_n", "_g", "_hm")
    placed = scored.join(bounded(sites, 100_000), F.col("_host").eqNullSafe(F.col("_h")) & F.col("_path").eqNullSafe(F.col("_p")))
    prior = (b * F.col("_hm") + (F.col("_g") - F.col("_good")) / MILLION) / (b + F.col("_n") - 1)
    prior = F.least(F.lit(0.999), F.greatest(F.lit(0.001), prior))
    out = placed.withColumn("site_prior", prior).withColumn("score", 1 / (1 + F.exp(-(_odds(F.col("site_prior")) + F.col("_llr")))))
    return out.select(F.col("_id").alias(id_col), "_t", F.col("_llr").alias("evidence"), "site_prior", "score", (F.col("score") >= threshold).alias("kept"))


def good_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are kept, unchanged."""
    bad = judge(docs, labels, id_col, text_col, **options).filter(~F.col("kept")).select(F.col(id_col).alias("_id"), "_t")
    return without(docs, bad, id_col, text_col)


@query("op8_site_quality")
def op8(spark, sf_dir):
    judged = judge(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged.select("doc_id", F.round("evidence", 6).alias("evidence"), F.round("site_prior", 6).alias("site_prior"), F.round("score", 6).alias("score"), "kept")
