"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams of one to three letters (other characters count as a space) are hashed into 2^15 features; a
feature's value is its share of the text's n-grams times its inverse document frequency, which is
counted over all documents that may be learnt from.  Weights are trained by follow-the-regularised-
leader (proximal, elastic net) on a bounded sample, then a temperature is fitted on a held-back fifth.
The sample draws from every language in proportion to its different texts, ``LEAST`` of them at least;
what reaches the driver are its texts' features, bounded in rows and bytes.

Only ``text`` enters a prediction.  A text that is null or has no letter is ``und`` with score 0, as is
every text where no language could be learnt.  Rows of null text or language are not learnt from;
repeated ones are drawn once and predicted one by one.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = 15
SIZE = 1 << BITS
ORDERS = (1, 2, 3)
#: Texts that the weights are fitted on, together and from each language at least; all others add to the statistics.
SAMPLE, LEAST = 6000, 50
#: Bytes of the sample's features on the driver.
SAMPLE_BYTES = 256 << 20
#: Features are scaled so that a usual text has a norm near 1.
SCALE = 16.0
SLICE_CHARS, SLICE_TEXTS = 1 << 19, 512
MERGE_TASKS = 16
#: Documents whose best language is less likely than this are rejected by ``keep_known``.
LEAST_SCORE = 0.4

_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.frombuffer(b"".join(b"\1" if chr(i).isalpha() else b"\0" for i in range(0x110000)), np.bool_)
    return _letters


def _buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature of every n-gram of the texts, one text after another, and each text's first."""
    low = [f" {t.lower()} " for t in texts]
    code = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _is_letter()[code]
    code = np.where(letter, code, np.uint32(32))
    upto = np.concatenate([[0], np.cumsum([len(t) for t in low])])
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one space after each run of letters
    keep[upto[:-1]] = True
    kept = np.concatenate([[0], np.cumsum(keep)])[upto]
    code = code[keep].astype(np.uint64)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(kept))
    grams, owners, h = [], [], np.zeros(len(code), np.uint64)
    for n in ORDERS:
        with np.errstate(over="ignore"):
            h = (h[: len(code) - n + 1] * np.uint64(0x100000001B3) + code[n - 1 :] + np.uint64(n)) if len(code) >= n else h[:0]
            f = ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int32)
        same = owner[: len(f)] == owner[n - 1 : n - 1 + len(f)]
        grams.append(f[same])
        owners.append(owner[: len(f)][same])
    return np.concatenate(grams), np.concatenate(owners)


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    i = 0
    while i < len(texts):
        j, n = i, 0
        while j < len(texts) and j - i < SLICE_TEXTS and (j == i or n + len(texts[j]) <= SLICE_CHARS):
            n += len(texts[j])
            j += 1
        yield i, j
        i = j


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """For each feature the number of texts that have it, and the number of texts; over all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(SIZE, np.int64), 0
        for batch in batches:
            rows = batch.column(0).fill_null("").to_pylist()
            for i, j in _slices(rows):
                f, owner = _buckets(rows[i:j])
                seen = np.zeros((j - i, SIZE), np.bool_)
                seen[owner, f] = True
                total += seen.sum(0)
                n += j - i
        yield pa.record_batch([pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["n", "df"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(SIZE, np.int64), 0
        for batch in batches:
            n += sum(batch.column(0).to_pylist())
            for x in batch.column(1).to_pylist():
                total += np.frombuffer(x, np.int64)
        yield pa.record_batch([pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["n", "df"])

    schema = "n long, df binary"
    rows = texts.select("text").mapInArrow(count, schema).repartition(MERGE_TASKS).mapInArrow(add, schema).collect()
    return np.sum([np.frombuffer(r.df, np.int64) for r in rows], 0), sum(r.n for r in rows)


@dataclass
class LanguageModel:
    """Languages, weights by feature (TF-IDF scale included), bias and temperature."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), len(self.languages)), np.float64)
        for i, j in _slices(texts):
            f, owner = _buckets(texts[i:j])
            n = np.maximum(np.bincount(owner, minlength=j - i), 1)
            for c in range(len(self.languages)):
                out[i:j, c] = np.bincount(owner, self.weights[c][f], j - i) / n + self.bias[c]
        return out

    def logits_of(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The same for one text, from its features and how often it has each."""
        return self.weights[:, features] @ counts / max(counts.sum(), 1) + self.bias

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        z = self.logits(texts) / self.temperature
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        return p.argmax(1), p.max(1)


class Ftrl:
    """Follow the regularised leader, per coordinate, for a multinomial with an elastic net."""

    def __init__(self, classes: int, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.05) -> None:
        self.z, self.n = np.zeros((SIZE + 1, classes)), np.zeros((SIZE + 1, classes))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) > self.l1, w, 0.0)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        s = x @ w
        p = np.exp(s - s.max())
        p /= p.sum()
        p[label] -= 1
        g = np.outer(x, p)
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def drawn_sample(docs: DataFrame, sample: int = SAMPLE, seed: int = 1) -> tuple[list[str], list]:
    """The languages of ``docs`` (text, lang), and rows (lang, f, n) of a bounded sample: features and counts.

    A text is drawn by its hash, with a chance from the number of different texts of its language, and
    stands in the sample once however often it is repeated.
    """
    key = F.xxhash64(F.lit(seed), "text")
    stats = docs.groupBy("lang").agg(F.approx_count_distinct(key).alias("n")).collect()  # one row a language
    every = sum(r.n for r in stats)
    quota = {r.lang: max(LEAST, sample * r.n / max(every, 1)) for r in stats}
    if not quota:
        return [], []
    chances = [F.struct(F.lit(r.lang), F.lit(min(1.0, 1.2 * quota[r.lang] / max(r.n, 1))), F.lit(int(-(-quota[r.lang] // 1)))) for r in stats]
    chances = F.broadcast(docs.sparkSession.range(1).select(F.inline(F.array(*chances)).alias("lang", "_chance", "_most")))
    some = docs.withColumn("_key", key).join(chances, "lang")
    some = some.where(F.pmod("_key", F.lit(1 << 30)) < F.col("_chance") * (1 << 30)).dropDuplicates(["lang", "_key"])
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("_key"), "_key"))
    some = some.withColumn("_nth", nth).where("_nth <= _most")

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.unique(_buckets([t])[0], return_counts=True) for t in batch["text"].to_pylist()]
            f, n = (pa.array([x[k].astype(kind).tobytes() for x in rows], pa.binary()) for k, kind in enumerate((np.uint16, np.uint32)))
            yield pa.record_batch([batch["lang"], batch["_key"], f, n], ["lang", "_key", "f", "n"])

    rows = some.select("lang", "_key", "text").mapInArrow(featured, "lang string, _key long, f binary, n binary")
    upto = F.sum(F.octet_length("f") * 3).over(Window.partitionBy(F.lit(0)).orderBy(F.xxhash64("_key"), "lang"))  # a sample's rows
    rows = rows.withColumn("_upto", upto).where(F.col("_upto") <= SAMPLE_BYTES).collect()
    rows.sort(key=lambda r: (r.lang, r._key))
    return sorted(quota), [(r.lang, np.frombuffer(r.f, np.uint16), np.frombuffer(r.n, np.uint32)) for r in rows]


def fit(docs: DataFrame, sample: int = SAMPLE, epochs: int = 4, seed: int = 1) -> LanguageModel:
    """Learn from ``docs`` (text, lang): statistics over all rows, weights from a bounded sample."""
    docs = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")
    df, n_docs = document_frequencies(docs)
    idf = np.log((1 + n_docs) / (1 + df)) + 1
    languages, rows = drawn_sample(docs, sample, seed)
    if not languages:
        return LanguageModel([], np.zeros((0, SIZE)), np.zeros(0))
    rng = np.random.default_rng(seed)
    rows = [rows[i] for i in rng.permutation(len(rows))]
    cut = len(rows) // 5
    held, rows = rows[:cut], rows[cut:]
    model = Ftrl(len(languages))
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            lang, f, c = rows[i]
            x = np.append(SCALE * c / max(c.sum(), 1) * idf[f], 1.0)
            model.learn(np.append(f.astype(np.int64), SIZE), x, languages.index(lang))
    w = model.weights(slice(None))
    fitted = LanguageModel(languages, np.ascontiguousarray((w[:-1] * idf[:, None] * SCALE).T), w[-1].copy())
    if held:
        z = np.stack([fitted.logits_of(f, c) for _, f, c in held])
        fitted.temperature = _temperature(z, np.array([languages.index(lang) for lang, _, _ in held]))
    return fitted


def _temperature(z: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, by a search over a logarithmic grid."""
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))

    def loss(t: float) -> float:
        s = z / t - (z / t).max(1, keepdims=True)
        return float(np.mean(np.log(np.exp(s).sum(1)) - s[np.arange(len(y)), y]))

    return float(min(grid, key=loss))


def language(text: Column, model) -> Column:
    """struct<lang, score> for a broadcast model."""

    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = model.value
        for column in batches:
            texts = column.fill_null("").to_pylist()
            if m.languages and texts:
                best, score = m.predict(texts)
                lang = pa.array([m.languages[b] for b in best], pa.string())
            else:
                lang, score = pa.nulls(len(texts), pa.string()), np.zeros(len(texts))
            yield pa.StructArray.from_arrays([lang, pa.array(score, pa.float64())], ["lang", "score"])

    predict.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(predict, "struct<lang:string,score:double>")(text)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """Add ``lang_pred`` and ``score`` (in place of columns of these names)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    known = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)) & F.col("_l.lang").isNotNull()
    return (
        docs.withColumn("_l", language(F.col("text"), shared))
        .withColumns(
            {
                "lang_pred": F.when(known, F.col("_l.lang")).otherwise("und"),
                "score": F.when(known, F.col("_l.score")).otherwise(0.0),
            }
        )
        .drop("_l")
    )


def keep_known(docs: DataFrame, model: LanguageModel, least: float = LEAST_SCORE) -> DataFrame:
    """The documents whose language is recognised, columns as they came."""
    rows = docs.select(F.struct("*").alias("_row"), "text")
    return identify(rows, model).where((F.col("lang_pred") != "und") & (F.col("score") >= least)).select("_row.*")
