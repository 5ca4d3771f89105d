"""Toxicity by a linear-chain conditional random field (CRF).

Labelled tokens.  Labels are per document, so token labels come from a lexicon that the training
documents give: words and word beginnings (4 to 6 letters) that occur in toxic documents in many
distinct contexts (neighbouring words; so copies of one document count once) and hardly in clean
ones, by a likelihood ratio.  A token is labelled toxic if it has such a feature and its document is
labelled toxic.

Model.  Two tags, clean and toxic.  A token's score for toxic is a bias plus the weights of its
lexicon features; a 2 x 2 table scores neighbouring tags.  Weights maximise the conditional likelihood
less an L2 penalty.  Tokens without features all have one potential, so a run of n of them is the
n-th power of one 2 x 2 matrix: forward-backward visits the other tokens alone and is still exact.

Scores.  The marginals of a document (expected toxic tokens, highest marginal, toxic share) go through a
logistic function fitted on the training documents.  Offending offsets are the tokens whose marginal reaches ``span_at``.

Only the text is an input of a score.  Training reads a bounded sample (``most_labels`` rows); its texts stay in
tasks, and the driver gets feature counts and the positions of features.

Edge cases: a null or empty text has no tokens and gets the score of a document without features;
without any labelled rows the lexicon is empty and every score is 0.5 or less; repeated rows are
scored one by one; texts are scored whole.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, held_out, pieces, sampled_labels, saved, utf8
from .registry import query

#: Tokens: runs of ASCII letters (in lower case) and of everything beyond ASCII.
_TOKEN_BYTES = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
_TOKEN = re.compile("[A-Za-z\x80-\U0010ffff]+")
_BEGINNINGS = (4, 5, 6)


def tokens_of(text: str | None) -> list[bytes]:
    return utf8(text).translate(_TOKEN_BYTES).split()


def features_of(token: bytes) -> list[str]:
    word = token.decode("utf-8", "replace")
    return [word, *(word[:n] + "*" for n in _BEGINNINGS if len(word) > n)]


# --- the CRF -----------------------------------------------------------------------------------------------------


@dataclass
class Chains:
    """Documents as their tokens with features: row i has ``count[i]`` of them, padded to a common width."""

    count: np.ndarray  # documents
    gap: np.ndarray  # documents x width: tokens without features before each
    tail: np.ndarray  # documents: tokens without features after the last
    feats: list[list[list[int]]]

    @classmethod
    def of(cls, docs: list[tuple[int, list[int], list[list[int]]]]) -> Chains:
        """From (number of tokens, positions, features at each)."""
        count = np.array([len(p) for _, p, _ in docs], np.int64)
        gap = np.zeros((len(docs), max(count.max(initial=0), 1)), np.int64)
        tail = np.zeros(len(docs), np.int64)
        for i, (n, where, _) in enumerate(docs):
            if where:
                gap[i, :len(where)] = np.diff([-1, *where]) - 1
            tail[i] = n - 1 - where[-1] if where else n
        return cls(count, gap, tail, [f for _, _, f in docs])

    def classes(self) -> list[tuple[np.ndarray, int]]:
        """Rows and their common width: 0, 1, 2, 4, 8, ... (the table's own at most)."""
        power = np.where(self.count > 0, np.ceil(np.log2(np.maximum(self.count, 1))), -1)
        return [(np.flatnonzero(power == p), 0 if p < 0 else min(int(2**p), self.gap.shape[1])) for p in np.unique(power)]

    def scores(self, weights: np.ndarray) -> np.ndarray:
        out = np.zeros(self.gap.shape)
        for i, doc in enumerate(self.feats):
            for j, ks in enumerate(doc):
                out[i, j] = weights[ks].sum()
        return out


@dataclass
class Crf:
    """chain: scores of clean->toxic, toxic->clean, toxic->toxic, and the bias of toxic (clean->clean and clean score 0)."""

    features: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    chain: np.ndarray = field(default_factory=lambda: np.array([-3.0, -1.0, -1.0, -3.0]))
    document: np.ndarray = field(default_factory=lambda: np.zeros(4))

    def _step(self, chain: np.ndarray) -> np.ndarray:
        enter, leave, stay, bias = chain
        return np.exp(np.array([[0.0, enter + bias], [leave, stay + bias]]))

    @staticmethod
    def _power(step: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """step^n of each n, over its largest eigenvalue to the n, and the logarithm of that."""
        (a, b), (c, d) = step
        root = math.sqrt((a - d) ** 2 + 4 * b * c)
        high, low = (a + d + root) / 2, (a + d - root) / 2
        ratio = np.power(low / high, n.astype(np.float64))
        unit = np.eye(2)
        first, second = (step - low * unit) / root, (step - high * unit) / root
        return first - ratio[..., None, None] * second, n * math.log(high)

    def infer(self, chains: Chains, scores: np.ndarray, chain: np.ndarray | None = None, marginals: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """log Z of each document and the marginal of toxic of each token with features (zeros if not asked for).
        Documents go together by the power of two above their number of such tokens, so short ones aren't padded to long ones."""
        step = self._step(self.chain if chain is None else chain)
        log_z, marginal = np.zeros(len(chains.count)), np.zeros(chains.gap.shape)
        for rows, width in chains.classes():
            part = Chains(chains.count[rows], chains.gap[rows, :width], chains.tail[rows], [])
            log_z[rows], found = self._infer(part, scores[rows, :width], step, marginals)
            if marginals:
                marginal[rows, :width] = found
        return log_z, marginal

    def _infer(self, chains: Chains, scores: np.ndarray, step: np.ndarray, marginals: bool) -> tuple[np.ndarray, np.ndarray]:
        docs, width = chains.gap.shape
        gaps, gap_logs = self._power(step, chains.gap)
        tails, tail_logs = self._power(step, chains.tail)
        at = np.zeros((docs, 2))
        at[:, 0] = 1.0  # the tag before the text is clean
        log_z, forward = np.zeros(docs), np.zeros((docs, width, 2))
        boost = np.exp(np.minimum(scores, 50.0))
        for j in range(width):
            on = chains.count > j
            new = np.einsum("di,dij->dj", np.einsum("di,dij->dj", at, gaps[:, j]), np.broadcast_to(step, (docs, 2, 2)))
            new[:, 1] *= boost[:, j]
            total = new.sum(1)
            at = np.where(on[:, None], new / total[:, None], at)
            log_z += np.where(on, np.log(total) + gap_logs[:, j], 0.0)
            forward[:, j] = at
        back = tails.sum(2)
        log_z += np.log((at * back).sum(1)) + tail_logs
        marginal = np.zeros((docs, width))
        for j in range(width - 1, -1, -1) if marginals else ():
            on = chains.count > j
            both = forward[:, j] * back
            marginal[:, j] = np.where(on, both[:, 1] / both.sum(1), 0.0)
            late = back.copy()
            late[:, 1] *= boost[:, j]
            new = np.einsum("dij,dj->di", gaps[:, j], late @ step.T)
            back = np.where(on[:, None], new / new.sum(1, keepdims=True), back)
        return log_z, marginal

    def fit(self, chains: Chains, tags: np.ndarray, n_features: int, l2: float = 0.05, rounds: int = 60) -> None:
        """tags: 1 where a token with features is labelled toxic (documents x width)."""
        before = np.concatenate([np.zeros((len(tags), 1), tags.dtype), tags[:, :-1]], 1)
        joined = chains.gap == 0
        real = np.arange(tags.shape[1]) < chains.count[:, None]
        # of the labelled paths: clean->toxic, toxic->clean, toxic->toxic, toxic tokens
        stay = (tags & before & joined & real).sum()
        total = (tags & real).sum()
        last = np.take_along_axis(tags, np.maximum(chains.count - 1, 0)[:, None], 1)[:, 0] & (chains.count > 0) & (chains.tail == 0)
        gold = np.array([total - stay, total - stay - last.sum(), stay, total], np.float64)
        flat = [(i, j, ks) for i, doc in enumerate(chains.feats) for j, ks in enumerate(doc)]
        rows = np.repeat(np.arange(len(flat)), [len(ks) for _, _, ks in flat])
        cols = np.array([k for _, _, ks in flat for k in ks], np.int64)
        at = (np.array([i for i, _, _ in flat], np.int64), np.array([j for _, j, _ in flat], np.int64))
        theta, slope = np.concatenate([self.chain, np.zeros(n_features)]), np.zeros(4 + n_features)
        mean, square = np.zeros_like(theta), np.zeros_like(theta)
        for t in range(1, rounds + 1):
            scores = np.zeros(chains.gap.shape)
            scores[at] = np.bincount(rows, theta[4:][cols], len(flat))
            log_z, marginal = self.infer(chains, scores, theta[:4])
            slope[4:] = np.bincount(cols, (tags - marginal)[at][rows], n_features) - l2 * theta[4:]
            for k in range(4):  # four numbers: their expectations by differences of log Z
                moved = theta[:4].copy()
                moved[k] += 1e-4
                slope[k] = gold[k] - (self.infer(chains, scores, moved, marginals=False)[0] - log_z).sum() / 1e-4 - l2 * theta[k]
            mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
            theta = theta + 0.3 * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-8)
        self.chain, self.weights = theta[:4], theta[4:]

    def summaries(self, chains: Chains, marginal: np.ndarray, n_tokens: np.ndarray) -> np.ndarray:
        expected = marginal.sum(1)
        return np.column_stack([np.ones(len(expected)), np.log1p(expected), marginal.max(1, initial=0.0), np.log1p(100 * expected / np.maximum(n_tokens, 1))])

    def fit_document(self, x: np.ndarray, y: np.ndarray, l2: float = 0.1, rounds: int = 30) -> None:
        """Logistic regression by Newton's method."""
        beta = np.zeros(x.shape[1])
        for _ in range(rounds if len(y) else 0):
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            hessian = (x * (p * (1 - p))[:, None]).T @ x + l2 * np.eye(x.shape[1])
            beta = beta + np.linalg.solve(hessian, x.T @ (y - p) - l2 * beta)
        self.document = beta

    def score(self, summaries: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(summaries @ self.document, -30, 30)))


class Tagger:
    """Finds the tokens with features, with a bounded cache of words."""

    def __init__(self, features: dict[str, int], cache_words: int = 500_000):
        self.features, self.cache_words, self.cache = features, cache_words, {}

    def known(self, token: bytes) -> list[int]:
        if len(self.cache) >= self.cache_words:
            self.cache = {}
        self.cache[token] = found = [k for f in features_of(token) if (k := self.features.get(f)) is not None]
        return found

    def events(self, text: str | None) -> tuple[int, list[int], list[list[int]]]:
        tokens, cache = tokens_of(text), self.cache
        hot = {}
        for token in set(tokens):
            found = cache.get(token)
            if found is None:
                found = self.known(token)
                cache = self.cache
            if found:
                hot[token] = found
        where = [i for i, token in enumerate(tokens) if token in hot] if hot else []
        return len(tokens), where, [hot[tokens[i]] for i in where]


# --- training ----------------------------------------------------------------------------------------------------


def _contexts(sample: DataFrame, wanted: frozenset | None) -> DataFrame:
    """f, c: each feature (of ``wanted``, if given) with its distinct neighbourhoods in the texts of ``sample``."""
    def run(batches):
        for batch in batches:
            for part in pieces(batch, "_text"):
                found = set()
                for text in part.column("_text").to_pylist():
                    words = tokens_of(text)
                    for i, word in enumerate(words):
                        names = features_of(word) if wanted is None else [f for f in features_of(word) if f in wanted]
                        if names:
                            around = hash_of(words[i - 1] if i else b"", words[i + 1] if i + 1 < len(words) else b"")
                            found.update((f, around) for f in names)
                f, c = zip(*found, strict=True) if found else ((), ())
                yield pa.RecordBatch.from_arrays([pa.array(f, pa.string()), pa.array(c, pa.int64())], names=["f", "c"])

    return sample.select("_text").mapInArrow(run, "f string, c long").distinct().groupBy("f").agg(F.count(F.lit(1)).alias("n"))


def _lexicon(sample: DataFrame, least_gain: float, most_features: int) -> dict[str, int]:
    """Features by likelihood ratio of their distinct contexts in toxic against clean documents."""
    sizes = {r["_label"]: r["n"] or 0 for r in sample.groupBy("_label").agg(F.sum(F.length("_text")).alias("n")).collect()}
    rate = sizes.get(1, 0) / max(1, sum(sizes.values()))
    if not 0 < rate < 1:
        return {}
    # a feature of t toxic contexts and no clean one gains -2 t log(rate); the rest can't reach least_gain
    least = max(2, math.ceil(least_gain / (-2 * math.log(rate))))
    toxic = {r["f"]: r["n"] for r in _contexts(sample.filter("_label = 1"), None).filter(F.col("n") >= least).collect()}  # of the bounded sample
    clean = {r["f"]: r["n"] for r in _contexts(sample.filter("_label = 0"), frozenset(toxic)).collect()}
    gains = {}
    for f, t in toxic.items():
        n = clean.get(f, 0)
        gain = 2 * (t * math.log(t / ((t + n) * rate)) + (n * math.log(n / ((t + n) * (1 - rate))) if n else 0.0))
        if gain >= least_gain and t >= 4 * n:
            gains[f] = gain
    return {f: i for i, f in enumerate(sorted(sorted(gains, key=lambda f: (-gains[f], f))[:most_features]))}


def hash_of(left: bytes, right: bytes) -> int:
    return zlib.crc32(left) << 31 ^ zlib.crc32(right)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic",
          most_labels: int = 10_000, most_features: int = 2_000, least_gain: float = 25.0) -> Crf:
    """Learn from at most ``most_labels`` rows of ``labels`` (see ``sampled_labels``) and ``most_features`` features."""
    chosen = sampled_labels(labels, label, most_labels, id_col)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    sample = saved(texts.join(F.broadcast(chosen), "_id"))  # most_labels rows
    model = Crf(_lexicon(sample, least_gain, most_features))
    features = model.features

    def positions(batches):
        tagger = Tagger(features)
        for batch in batches:
            for part in pieces(batch, "_text"):
                found = [tagger.events(t) for t in part.column("_text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("_label"), pa.array([n for n, _, _ in found], pa.int64()), pa.array([w for _, w, _ in found], pa.list_(pa.int32())),
                     pa.array([f for _, _, f in found], pa.list_(pa.list_(pa.int32())))], names=["y", "n", "at", "feats"])

    rows = sample.mapInArrow(positions, "y int, n long, at array<int>, feats array<array<int>>").groupBy("y", "n", "at", "feats").agg(
        F.count(F.lit(1)).alias("copies")).orderBy("n", "y", "at").collect()  # at most most_labels rows of numbers
    rows = [r for r in rows for _ in range(r["copies"])]
    if rows:
        chains = Chains.of([(r["n"], r["at"], r["feats"]) for r in rows])
        y = np.array([r["y"] for r in rows], np.int64)
        tags = np.where(np.arange(chains.gap.shape[1]) < chains.count[:, None], y[:, None], 0)
        if features:
            model.fit(chains, tags, len(features))
        marginal = model.infer(chains, chains.scores(model.weights))[1]
        model.fit_document(model.summaries(chains, marginal, np.array([r["n"] for r in rows])), y)
    return model


# --- scoring -----------------------------------------------------------------------------------------------------


def score_documents(docs: DataFrame, model: Crf, id_col: str = "doc_id", text_col: str = "text", span_at: float = 0.5) -> DataFrame:
    """``id_col``, score and spans (array of start, end, marginal; code points, end exclusive) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most most_features features
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("marginal", pa.float64())])

    def run(batches):
        crf = shared.value
        tagger = Tagger(crf.features)
        for batch in batches:
            for part in pieces(batch, text_col):
                texts = part.column(text_col).to_pylist()
                found = [tagger.events(t) for t in texts]
                chains = Chains.of(found)
                marginal = crf.infer(chains, chains.scores(crf.weights))[1]
                scores = crf.score(crf.summaries(chains, marginal, np.array([n for n, _, _ in found])))
                spans = []
                for i, (text, (_, where, _)) in enumerate(zip(texts, found, strict=True)):
                    hits = {p: float(marginal[i, j]) for j, p in enumerate(where) if marginal[i, j] >= span_at}
                    spans.append([{"start": m.start(), "end": m.end(), "marginal": hits[p]} for p, m in enumerate(_TOKEN.finditer(text)) if p in hits] if hits else [])
                yield pa.RecordBatch.from_arrays([part.column(id_col), pa.array(scores, pa.float64()), pa.array(spans, pa.list_(span))], names=[id_col, "score", "spans"])

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *T.StructType.fromDDL(
        "score double, spans array<struct<start: long, end: long, marginal: double>>").fields])
    return docs.select(*dict.fromkeys([id_col, text_col])).mapInArrow(run, schema)


@query("op7_toxic_crf")
def op7(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_documents(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                               (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("spans").alias("n_spans"))
