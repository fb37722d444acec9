"""Toxicity: a convolutional classifier of words, with thresholds calibrated by language.

A word's vector is the sum of three hashed embeddings: of the whole word and of its first four and six
bytes, so that inflected forms share a vector.  Filters of widths 1, 2 and 3 slide over the words;
each filter's maximum over the whole text, rectified, enters a logistic output.  All is trained in
numpy on a bounded sample of labelled texts.

The decision threshold depends on the language, which is guessed from the text itself (naive Bayes
over the same hashed words, its language names learnt from the sample): the logit is shifted so that
each language's threshold, calibrated on held-back texts, falls on score 0.5.

A null text counts as empty; texts without words get the share of toxic texts, below 0.5.  Labels of a document that
contradict each other count as toxic.  Without both labels in the sample every score is 0.  Repeated rows
are scored one by one; columns named ``score`` and ``predicted`` are replaced.  Very long texts are scored in
windows that overlap by the widest filter less one word, since maxima of windows make the text's maximum.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestor.llm.words import Words, folded, run_hash, slices, text_arrays, windows, word_slices, words

BITS = 16
SIZE = 1 << BITS
WIDTHS = (1, 2, 3)
PREFIXES = (4, 6)
DIM, FILTERS = 16, 16
#: Labelled documents that the model is fitted on, as expected by hash; and bounds of rows and of bytes of text.
SAMPLE, SAMPLE_ROWS, SAMPLE_BYTES, SAMPLE_PARTS = 8000, 16_000, 128 << 20, 64
#: Bytes of a text beyond which it is scored in windows of so many.
WINDOW = 1 << 20
#: Texts of a language among the held-back, from which on it has a threshold of its own.
LEAST_TEXTS = 40


def features(w: Words) -> np.ndarray:
    """Embedding rows of each word: (words, 1 + prefixes)."""
    cols = [w.hashes] + [run_hash(w.data, w.starts, np.minimum(w.ends, w.starts + p), 10 + p) for p in PREFIXES]
    return np.stack([(h >> np.uint64(64 - BITS)).astype(np.int32) for h in cols], 1)


@dataclass
class ToxicityModel:
    emb: np.ndarray
    conv: np.ndarray  # (DIM, sum(WIDTHS) * FILTERS): one block of FILTERS for each place in each width
    conv_bias: np.ndarray
    out: np.ndarray
    out_bias: float
    languages: list[str] = field(default_factory=list)
    word_lang: np.ndarray | None = None
    prior: np.ndarray | None = None
    thresholds: dict[str, float] = field(default_factory=dict)
    default: float = 0.0
    base: float = 0.0

    @classmethod
    def new(cls, seed: int) -> ToxicityModel:
        rng = np.random.default_rng(seed)
        n = len(WIDTHS) * FILTERS
        return cls(
            rng.normal(0, 0.1, (SIZE, DIM)).astype(np.float32),
            rng.normal(0, 0.3, (DIM, sum(WIDTHS) * FILTERS)).astype(np.float32),
            np.zeros(n, np.float32), rng.normal(0, 0.3, n).astype(np.float32), 0.0,
        )

    def responses(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Filter responses by word (words, widths * FILTERS); a run that leaves the text is -inf."""
        y, at, parts = x @ self.conv, 0, []
        left = np.repeat(first[1:], np.diff(first)) - np.arange(len(x)) if len(x) else np.zeros(0, int)
        for width in WIDTHS:
            z = y[:, at : at + FILTERS].copy()
            for j in range(1, width):
                z[:-j] += y[j:, at + j * FILTERS : at + (j + 1) * FILTERS]
            z[left < width] = -np.inf
            parts.append(z)
            at += width * FILTERS
        return np.concatenate(parts, 1)

    def pooled(self, z: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Rectified maxima by text; no run at all gives 0."""
        m = np.full((len(first) - 1, z.shape[1]), -np.inf, np.float32)
        some = np.diff(first) > 0
        if some.any():
            m[some] = np.maximum.reduceat(z, first[:-1][some], 0)
        return m + self.conv_bias

    def tops(self, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Each text's maximum of every filter."""
        x = self.emb[rows].sum(1) if len(rows) else np.zeros((0, DIM), np.float32)
        return self.pooled(self.responses(x, first), first)

    def logits(self, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
        return np.maximum(self.tops(rows, first), 0) @ self.out + self.out_bias

    def evidence(self, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Log likelihood of each text's words by language."""
        score = np.zeros((len(first) - 1, len(self.languages)))
        some = np.diff(first) > 0
        if some.any():
            score[some] += np.add.reduceat(self.word_lang[rows[:, 0]], first[:-1][some], 0)
        return score

    def guess(self, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Index of each text's language."""
        return (self.prior + self.evidence(rows, first)).argmax(1)

    def _judged(self, tops: np.ndarray, evidence: np.ndarray, some: np.ndarray) -> np.ndarray:
        """Scores from maxima and evidence; ``some``: which texts have words."""
        shift = np.array([self.thresholds.get(x, self.default) for x in self.languages])[(self.prior + evidence).argmax(1)]
        score = 1 / (1 + np.exp(-np.clip(np.maximum(tops, 0) @ self.out + self.out_bias - shift, -30, 30)))
        return np.where(some, score, self.base)

    def score(self, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
        if not self.languages:
            return np.zeros(len(first) - 1)
        return self._judged(self.tops(rows, first), self.evidence(rows, first), np.diff(first) > 0)

    def score_long(self, data: np.ndarray, most: int) -> float:
        """The score of one text of many bytes, in windows."""
        if not self.languages:
            return 0.0
        tops, evidence, some = np.full((1, len(self.conv_bias)), -np.inf), np.zeros((1, len(self.languages))), False
        for w, again in windows(data, most, max(WIDTHS) - 1):
            rows = features(w)
            tops = np.maximum(tops, self.tops(rows, w.first))
            evidence += self.evidence(rows[again:], np.array([0, len(rows) - again]))
            some = some or len(rows) > 0
        return float(self._judged(tops, evidence, np.array([some]))[0])


class _Trainer:
    """Adagrad on mini-batches; gradients pass through the maxima alone."""

    def __init__(self, model: ToxicityModel, rate: float = 0.05) -> None:
        self.m, self.rate = model, rate
        self.sums = {k: np.full_like(getattr(model, k), 1e-6) for k in ("emb", "conv", "conv_bias", "out")}
        self.bias_sum = 1e-6

    def _step(self, name: str, grad: np.ndarray, at=slice(None)) -> None:
        s = self.sums[name]
        s[at] += grad * grad
        getattr(self.m, name)[at] -= self.rate * grad / np.sqrt(s[at])

    def learn(self, rows: np.ndarray, first: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        m = self.m
        x = m.emb[rows].sum(1)
        z = m.responses(x, first)
        top = m.pooled(z, first)
        act = np.maximum(top, 0)
        p = 1 / (1 + np.exp(-np.clip(act @ m.out + m.out_bias, -30, 30)))
        d = ((p - y) * weight / len(y)).astype(np.float32)
        d_top = np.outer(d, m.out) * (top > 0)
        text, filt = np.nonzero(d_top)
        # where each maximum stands: the first word of its text that reaches it
        owner = np.repeat(np.arange(len(y)), np.diff(first))
        hit_word, hit_filter = np.nonzero(z == (top - m.conv_bias)[owner])
        place = np.full(top.shape, -1, np.int64)
        place[owner[hit_word[::-1]], hit_filter[::-1]] = hit_word[::-1]
        word, g = place[text, filt], d_top[text, filt]
        ok = word >= 0
        filt, word, g = filt[ok], word[ok], g[ok]
        d_conv, at = np.zeros_like(m.conv), 0
        d_rows, d_vals = [], []
        for k, width in enumerate(WIDTHS):
            mine = (filt >= k * FILTERS) & (filt < (k + 1) * FILTERS)
            f, w, gg = filt[mine] - k * FILTERS, word[mine], g[mine]
            for j in range(width):
                col = at + j * FILTERS + f
                np.add.at(d_conv.T, col, gg[:, None] * x[w + j])
                d_rows.append(rows[w + j])
                d_vals.append(gg[:, None] * m.conv.T[col])
            at += width * FILTERS
        self._step("out", d @ act)
        self._step("conv_bias", d_top.sum(0))
        self._step("conv", d_conv)
        gb = float(d.sum())
        self.bias_sum += gb * gb
        m.out_bias -= self.rate * gb / self.bias_sum**0.5
        r, v = np.concatenate(d_rows), np.concatenate(d_vals)
        ids, inv = np.unique(r, return_inverse=True)
        grad = np.zeros((len(ids), DIM), np.float32)
        np.add.at(grad, inv.reshape(r.shape).ravel(), np.repeat(v, r.shape[1], 0))
        self._step("emb", grad, ids)


def _threshold(z: np.ndarray, y: np.ndarray) -> float:
    """The cut of fewest errors on (logit, label); of equal ones the middle of the widest gap."""
    order = np.argsort(z)
    z, y = z[order], y[order]
    errors = np.concatenate([[0], np.cumsum(y)]) + np.concatenate([np.cumsum((1 - y)[::-1])[::-1], [0]])
    edges = np.concatenate([[z[0] - 4], z, [z[-1] + 4]])
    gaps = np.diff(edges)
    best = max(np.flatnonzero(errors == errors.min()), key=lambda i: gaps[i])
    return float((edges[best] + edges[best + 1]) / 2)


def fit(rows: list[tuple[str, int, str | None]], epochs: int = 5, batch: int = 32, seed: int = 3) -> ToxicityModel:
    """Fit on (text, toxic, lang); ``lang`` only names the languages whose thresholds are calibrated."""
    model = ToxicityModel.new(seed)
    y = np.array([r[1] for r in rows], np.float32)
    if not len(rows) or y.min() == y.max():
        return model
    rows_of, firsts = [], []
    for _, _, w in word_slices(pa.array([r[0] for r in rows], pa.string())):
        f = features(w)
        rows_of += [f[a:b] for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
    langs = sorted({r[2] or "" for r in rows})
    lang = np.array([langs.index(r[2] or "") for r in rows])
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    held, train = order[: len(rows) // 5], order[len(rows) // 5 :]

    counts = np.full((SIZE, len(langs)), 0.1)
    for i in train:
        counts[:, lang[i]] += np.bincount(rows_of[i][:, 0], minlength=SIZE) if len(rows_of[i]) > 2000 else 0
        if len(rows_of[i]) <= 2000:
            np.add.at(counts[:, lang[i]], rows_of[i][:, 0], 1)
    model.languages = langs
    model.base = min(float(y.mean()), 0.49)
    model.word_lang = np.log(counts / counts.sum(0)).astype(np.float32)
    model.prior = np.log((np.bincount(lang[train], minlength=len(langs)) + 1.0) / (len(train) + len(langs)))

    def joined(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts = [rows_of[i] for i in ids]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    weight = np.where(y > 0, np.clip((y == 0).sum() / max(y.sum(), 1), 1, 5) ** 0.5, 1).astype(np.float32)
    trainer = _Trainer(model)
    for _ in range(epochs):
        mixed = rng.permutation(train)
        for i in range(0, len(mixed), batch):
            ids = mixed[i : i + batch]
            r, first = joined(ids)
            if len(r):
                trainer.learn(r, first, y[ids], weight[ids])
    if len(held) and 0 < y[held].mean() < 1:
        z, guess = np.concatenate([model.logits(*joined(held[i : i + 64])) for i in range(0, len(held), 64)]), []
        for i in range(0, len(held), 64):
            guess.append(model.guess(*joined(held[i : i + 64])))
        guess = np.concatenate(guess)
        model.default = _threshold(z, y[held])
        for k, name in enumerate(langs):
            mine = guess == k
            if mine.sum() >= LEAST_TEXTS and 0 < y[held][mine].mean() < 1:
                model.thresholds[name] = _threshold(z[mine], y[held][mine])
    return model


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, seed: int = 1) -> list[tuple[str, int, str | None]]:
    """About ``sample`` labelled documents, drawn by the hash of their ids, in a fixed order.

    At most ``SAMPLE_ROWS`` rows of ``SAMPLE_BYTES`` together; a text above 1 / ``SAMPLE_PARTS`` of these bytes is not learnt
    from.  Repeated rows stand as often as they are drawn.
    """
    labels = labels.select("doc_id", "toxic").where("doc_id is not null and toxic is not null")
    n = labels.count()
    drawn = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) <= F.lit(int(min(1.0, sample / max(n, 1)) * (1 << 30)))
    few = labels.where(drawn).groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    few = few.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS)
    some = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang").where(drawn).withColumn("_h", F.xxhash64("text"))
    # lengths alone are ordered and summed; a single text never takes more than a small part of the bound
    slim = some.join(F.broadcast(few), "doc_id").select("doc_id", "_h", "_toxic", F.octet_length("text").alias("_size")).where(F.col("_size") <= SAMPLE_BYTES // SAMPLE_PARTS)
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("_h")]
    slim = slim.orderBy(*order).limit(SAMPLE_ROWS)  # a doc_id may stand for many rows
    slim = slim.withColumn("_upto", F.sum("_size").over(Window.partitionBy(F.lit(0)).orderBy(*order))).where(F.col("_upto") <= SAMPLE_BYTES)
    picked = slim.groupBy("doc_id", "_h", "_toxic").agg(F.count(F.lit(1)).alias("_times"))
    rows = some.join(F.broadcast(picked), ["doc_id", "_h"]).dropDuplicates(["doc_id", "_h"]).select("doc_id", "text", "_toxic", "lang", "_times").collect()
    return [(r.text, int(r._toxic), r.lang) for r in sorted(rows, key=lambda r: (r.doc_id, r.text)) for _ in range(r._times)]


def toxicity(text: Column, model) -> Column:
    """The score of ``text`` for a broadcast model."""

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = model.value
        for column in batches:
            data, offsets = text_arrays(column)
            out = []
            for i, j in slices(offsets, WINDOW):
                part = folded(data[offsets[i] : offsets[j]])
                if len(part) > WINDOW:
                    out.append([m.score_long(part, WINDOW)])
                else:
                    w = words(part, offsets[i : j + 1] - offsets[i])
                    out.append(m.score(features(w), w.first))
            yield pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())

    score.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(score, "double")(text)


def score_documents(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 from 0.5)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.withColumn("score", toxicity(F.col("text"), shared)).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
