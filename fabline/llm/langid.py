"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies are counted over every training document. The weights are fitted on a bounded sample
(``per_lang`` documents a language, chosen by hash) with follow-the-regularised-leader and an elastic-net
penalty; a held-back part of the sample sets the softmax temperature. Prediction reads whole texts.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import few_rows, fresh
from .token_count import slices

BITS = 15
SLOTS = 1 << BITS
ORDERS = 3
BLOCK_CHARS = 1 << 19
#: Per-order offset and per-place multipliers of the n-gram hash (odd, arbitrary, fixed).
OFFSETS = (0x3C6EF372, 0x1B873593, 0x27D4EB2F)
FACTORS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)
UNKNOWN = "und"


def ngram_slots(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Code point ranges of the texts (each between two blanks) and, per order, the slot of the n-gram at
    each place; places too near a text's end get slot ``SLOTS``."""
    padded = [f" {t.lower()} " for t in texts]
    size = np.fromiter(map(len, padded), dtype=np.int64, count=len(padded))
    code = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = np.cumsum(size)
    out, h = [], np.zeros(len(code), dtype=np.uint32)
    for n in range(ORDERS):
        part = np.zeros(len(code), dtype=np.uint32)
        part[:len(code) - n] = code[n:] * np.uint32(FACTORS[n])
        h = (h ^ (h >> np.uint32(15))) * np.uint32(FACTORS[0]) + part
        slot = (((h + np.uint32(OFFSETS[n])) * np.uint32(FACTORS[1])) >> np.uint32(32 - BITS)).astype(np.int32)
        for back in range(1, n + 1):
            at = ends - back
            slot[at[at >= ends - size]] = SLOTS
        out.append(slot)
    return ends - size, size, out


def grams(size: np.ndarray) -> np.ndarray:
    """How many n-grams of all orders a text of so many code points has."""
    return sum(np.maximum(size - n, 0) for n in range(ORDERS))


@dataclass
class Model:
    langs: list[str] = field(default_factory=list)
    table: np.ndarray | None = None  # slot -> weight * idf by language; the last row is zero
    bias: np.ndarray | None = None
    temperature: float = 1.0

    def logits(self, texts: list[str]) -> np.ndarray:
        start, size, slots = ngram_slots(texts)
        total = sum(np.add.reduceat(self.table[s], start, axis=0) for s in slots)
        return (total / grams(size)[:, None] + self.bias) / self.temperature

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
        known = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))] if self.langs else []
        for a, b in slices([len(texts[i]) for i in known], BLOCK_CHARS):
            p = softmax(self.logits([texts[i] for i in known[a:b]]).astype(np.float64))
            best = p.argmax(axis=1)
            for i, k, x in zip(known[a:b], best.tolist(), p.max(axis=1).tolist()):
                lang[i], score[i] = self.langs[k], min(1.0, x)
        return lang, score


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def held_out(id_col) -> F.Column:
    """Documents that training never sees: crc32 of the id as text is divisible by 5 (a null id counts as '')."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def document_frequencies(texts: DataFrame) -> np.ndarray:
    """In how many rows of (text) each slot occurs, over all rows; per task at most one row per slot."""
    def run(batches):
        seen = np.zeros(SLOTS + 1, dtype=np.int64)
        for batch in few_rows(batches):
            rows = [t for t in batch.column(0).to_pylist() if t]
            for a, b in slices(list(map(len, rows)), BLOCK_CHARS):
                _, size, slots = ngram_slots(rows[a:b])
                owner = np.repeat(np.arange(b - a, dtype=np.int64), size) * (SLOTS + 1)
                for lo in range(0, b - a, 256):  # bounded presence table
                    hi = min(lo + 256, b - a)
                    part = slice(int(size[:lo].sum()), int(size[:hi].sum()))
                    has = np.zeros((hi - lo) * (SLOTS + 1), dtype=bool)
                    for s in slots:
                        has[owner[part] - lo * (SLOTS + 1) + s[part]] = True
                    seen += has.reshape(hi - lo, -1).sum(axis=0)
        at = np.flatnonzero(seen[:SLOTS])
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(seen[at], pa.int64())], ["slot", "docs"])

    df = np.zeros(SLOTS)
    for r in texts.mapInArrow(run, "slot bigint, docs bigint").groupBy("slot").agg(F.sum("docs").alias("docs")).collect():
        df[r["slot"]] = r["docs"]  # at most SLOTS rows
    return df


def sample_features(rows: DataFrame) -> list:
    """Sparse counts of the sample's texts: rows (id, lang, slots, counts, grams)."""
    def run(batches):
        for batch in few_rows(batches):
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out = ([], [], [], [])
            for lang, t in zip(langs, texts):
                _, size, slots = ngram_slots([t])
                at, n = np.unique(np.concatenate(slots), return_counts=True)
                keep = at < SLOTS
                for col, v in zip(out, (lang, at[keep], n[keep], int(grams(size)[0]))):
                    col.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.string()), pa.array(out[1], pa.list_(pa.int32())),
                 pa.array(out[2], pa.list_(pa.int32())), pa.array(out[3], pa.int64())], ["lang", "slots", "counts", "grams"])

    return rows.mapInArrow(run, "lang string, slots array<int>, counts array<int>, grams bigint").collect()


def ftrl(samples: list[tuple[np.ndarray, np.ndarray, int]], classes: int, passes: int = 8, alpha: float = 0.5,
         beta: float = 1.0, l1: float = 1e-4, l2: float = 1e-4, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal for softmax regression on (slots, values, class); the last row is the bias."""
    z, n = np.zeros((SLOTS + 1, classes)), np.zeros((SLOTS + 1, classes))

    def weights(at):
        zi = z[at]
        w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        return np.where(np.abs(zi) <= l1, 0.0, w)

    order = np.random.default_rng(seed)
    for _ in range(passes):
        for i in order.permutation(len(samples)):
            at, x, y = samples[i]
            at, x = np.append(at, SLOTS), np.append(x, 1.0)
            w = weights(at)
            p = softmax(x @ w)
            p[y] -= 1.0
            g = x[:, None] * p[None, :]
            s = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - s * w
            n[at] += g * g
    w = weights(np.arange(SLOTS + 1))
    return w[:SLOTS], w[SLOTS]


def calibrate(logits: np.ndarray, y: np.ndarray) -> float:
    """Temperature of least negative log likelihood, from a fine grid."""
    grid = np.exp(np.linspace(np.log(0.02), np.log(20), 200))
    loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(y)), y], 1e-300)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def train(docs: DataFrame, per_lang: int = 500, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          scale: float = 20.0) -> Model:
    """Fit on the rows whose id is not held out, with lang and text present (an empty model if none).

    ``per_lang`` bounds the fitting sample; document frequencies cover all training rows.
    """
    rows = (docs.where(~held_out(F.col(id_col))).select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
            .where("lang IS NOT NULL AND text IS NOT NULL AND text <> ''"))
    per = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not per:
        return Model()
    langs = sorted(per)
    df = document_frequencies(rows.select("text"))
    idf = np.log((1 + sum(per.values())) / (1 + df)) + 1
    key = F.conv(F.substring(F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(2.0 ** 32)
    share = F.lit(1.0)
    for lang, n in per.items():  # about twice the bound by hash, then exactly the bound
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, 2 * per_lang / n))).otherwise(share)
    first = Window.partitionBy("lang").orderBy("key", "id")
    picked = (rows.withColumn("key", key).where(F.col("key") < share).withColumn("rank", F.row_number().over(first))
              .where(F.col("rank") <= per_lang).select("lang", "text"))
    samples, keep = [], []
    for r in sample_features(picked):
        at = np.array(r["slots"], dtype=np.int64)
        samples.append((at, scale * idf[at] * np.array(r["counts"]) / r["grams"], langs.index(r["lang"])))
    samples.sort(key=lambda s: (s[2], len(s[0]), s[0][:32].tolist(), s[1][:32].tolist()))  # the same order each run
    fit, keep = [s for i, s in enumerate(samples) if i % 5], samples[::5]
    w, bias = ftrl(fit, len(langs))
    table = np.zeros((SLOTS + 1, len(langs)), dtype=np.float32)
    table[:SLOTS] = scale * idf[:, None] * w
    logits = np.array([x @ w[at] + bias for at, x, _ in keep])
    return Model(langs, table, bias, calibrate(logits, np.array([s[2] for s in keep])))


def predict(docs: DataFrame, model: Model, out: tuple[str, str] = ("lang_pred", "score"), text_col: str = "text",
            keep: list[str] | None = None) -> DataFrame:
    """Add the predicted language and its calibrated probability to the columns ``keep`` (default: all).

    ``und`` with score 0 where the text is null or has no letter, or nothing was learned.
    """
    cols = docs.columns if keep is None else keep
    at = len(cols)
    shape = docs.select(*cols).schema.add(out[0], "string").add(out[1], "double")

    def run(batches):
        for batch in few_rows(batches):
            lang, score = model.predict(batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                             names=[f.name for f in shape.fields])

    return docs.select(*[docs[c] for c in cols], docs[text_col].alias(fresh(docs, "text_"))).mapInArrow(run, shape)


def identify(docs: DataFrame, per_lang: int = 500, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Train on ``docs`` and predict every row: id, held_out, lang_pred, score."""
    model = train(docs, per_lang, id_col, text_col, lang_col)
    rows = predict(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), model, keep=["id"])
    return rows.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "lang_pred", "score")
