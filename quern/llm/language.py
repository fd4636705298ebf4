"""Language identification by error-correcting output codes.

Every language has a codeword of signs; each bit of it divides the languages into two sides. A bit is predicted by a
binary classifier over letter n-grams (orders 1 to ``ORDERS`` inside blank-padded words, hashed to ``BUCKETS``): naive Bayes between
the two sides, every language of a side counting alike, then a slope and an intercept fitted by logistic regression.
Decoding is loss-weighted: a language's loss is the logistic loss of its bits against the predicted margins, each bit
weighted by how surely it was right on that language's training rows. The language of least loss wins, equal losses go to
the smaller name; ``ambiguous`` flags a runner-up within ``AMBIGUOUS``.

The codes are exhaustive up to seven languages, else the best spaced of ``TRIES`` seeded random matrices.

Training reads at most ``PER_LANGUAGE`` rows of each language (those of smallest hash of id and text); more than ``MAX_LANGUAGES``
languages raise an error, so the shares drawn per language are a small table, sent to the scan. Their n-grams are counted in
Spark; the driver holds languages x ``BUCKETS`` counts and one margin per bit and training row. All rows are scored in the scan, whole texts,
with the scores of a chunk's distinct words looked up once. Ids, languages and sources are no features.

Text without a letter (null, empty, digits) is ``und`` with score 0 and ambiguous, and no training row. Rows with null language or null id
are scored, not learned from. Repeated rows score alike. Without training rows all is ``und``; one language is given to all text with letters.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.text import map_chunks, text_bytes, unused
from quern.session import stage

PER_LANGUAGE = 2_000
MAX_LANGUAGES = 1_000
ORDERS = 4
BITS = 16
BUCKETS = 1 << BITS
SMOOTHING = 0.5
AMBIGUOUS = 0.5
TRIES = 64
CHUNK_BYTES = 16 << 20
UNKNOWN = "und"

_WORD = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def words_of(text: str | None) -> list[str]:
    """Lower-case runs of letters; without any letter none."""
    if not text:
        return []
    words = _WORD.findall(unicodedata.normalize("NFC", text).lower())
    return words if any(c.isalpha() for w in words for c in w) else []


def gram_places(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For every n-gram of the padded words the number of its word and its bucket."""
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    codes = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.append(np.repeat(np.arange(len(words)), sizes), len(words))
    blank = codes == 32
    hashes, whole = np.zeros(len(codes), dtype=np.uint64), np.ones(len(codes), dtype=bool)
    owners, places = [], []
    for order in range(ORDERS):
        n = len(codes) - order
        hashes = hashes[:n] * np.uint64(0x100000001B3) + codes[order:]
        whole = whole[:n] & ~blank[order - 1:order - 1 + n] if order > 1 else whole[:n]  # a blank only at the ends
        kept = np.flatnonzero(whole & (owner[:n] < len(words)) & ~(blank[:n] & (order == 0)))
        mixed = (hashes[kept] ^ np.uint64(order + 1)) * np.uint64(0x9E3779B97F4A7C15)
        owners.append(owner[kept])
        places.append((mixed >> np.uint64(64 - BITS)).astype(np.int64))
    return np.concatenate(owners), np.concatenate(places)


def chunk_words(texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct words of the texts, the word numbers of all texts in turn, and how many each text has."""
    number: dict[str, int] = {}
    ids, sizes = [], np.zeros(len(texts), dtype=np.int64)
    for row, text in enumerate(texts):
        found = words_of(text)
        sizes[row] = len(found)
        ids.append(np.array([number.setdefault(w, len(number)) for w in found], dtype=np.int64))
    return list(number), np.concatenate(ids) if ids else np.zeros(0, dtype=np.int64), sizes


def code_matrix(n: int) -> np.ndarray:
    """Codewords of ``n`` languages as rows of -1 and 1."""
    if n < 2:
        return np.ones((n, 0), dtype=np.int8)
    if n <= 7:
        columns = [c for c in product((1, -1), repeat=n) if -1 in c and c[0] == 1]
        return np.array(columns, dtype=np.int8).T
    rng, best, spaced = np.random.default_rng(n), None, -1
    for _ in range(TRIES):
        codes = rng.choice(np.array([-1, 1], dtype=np.int8), size=(n, math.ceil(15 * math.log2(n))))
        codes = codes[:, abs(codes.sum(0)) < n]
        alike = codes.astype(np.int32) @ codes.T
        least = int((codes.shape[1] - alike[~np.eye(n, dtype=bool)].max()) // 2)
        if least > spaced:
            best, spaced = codes, least
    return best


@dataclass
class EcocModel:
    languages: list[str]
    codes: np.ndarray  # languages x bits
    grams: np.ndarray  # buckets x bits: log odds of a side
    slope: np.ndarray
    shift: np.ndarray
    trust: np.ndarray  # languages x bits, rows sum to 1

    def margins(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Mean log odds of the n-grams of each text per bit, and whether it has a letter."""
        words, ids, sizes = chunk_words(texts)
        known = sizes > 0
        bits = self.grams.shape[1]
        if not len(words):
            return np.zeros((len(texts), bits)), known
        owner, place = gram_places(words)
        grams = np.bincount(owner, minlength=len(words)).astype(float)
        starts = np.append(0, np.cumsum(sizes))[:-1][known]
        length = np.add.reduceat(grams[ids], starts)
        out = np.zeros((len(texts), bits))
        for bit in range(bits):
            worth = np.bincount(owner, weights=self.grams[place, bit], minlength=len(words))
            out[known, bit] = np.add.reduceat(worth[ids], starts) / length
        return out, known

    def losses(self, margins: np.ndarray) -> np.ndarray:
        signed = (margins * self.slope + self.shift)[:, None, :] * self.codes[None]
        return (np.logaddexp(0, -signed) * self.trust[None]).sum(2)

    def decode(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and ambiguity of each text."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
        margins, known = self.margins(texts)
        losses = self.losses(margins)
        best = losses.argmin(1)
        likely = np.exp((losses.min(1, keepdims=True) - losses) * max(1, self.codes.shape[1]))
        gap = np.partition(losses, 1, axis=1)[:, 1] - losses.min(1) if len(self.languages) > 1 else np.full(len(texts), np.inf)
        names = [self.languages[i] if k else UNKNOWN for i, k in zip(best, known)]
        return names, np.where(known, 1 / likely.sum(1), 0.0), ~known | (gap < AMBIGUOUS)


def training_rows(docs: DataFrame, text_col: str, id_col: str, lang_col: str, per_language: int) -> DataFrame:
    """``(lang, text)``: at most ``per_language`` rows of each language. A row count per language first bounds what is shuffled."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).filter(
        F.col("lang").isNotNull() & F.col("id").isNotNull() & ~held_out(F.col("id")) & F.col("text").rlike(r"\p{L}"))
    counted = rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(counted) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    rates = docs.sparkSession.createDataFrame([(r["lang"], (1.2 * per_language + 50) / r["count"]) for r in counted], "lang string, rate double")
    drawn = rows.withColumn("draw", F.xxhash64("id", "text")).join(F.broadcast(rates), "lang").filter(
        F.pmod("draw", F.lit(1 << 30)) / float(1 << 30) < F.col("rate"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("draw", F.lit(1 << 30)), "draw", "id"))
    return drawn.withColumn("place", place).filter(F.col("place") <= per_language).select("lang", "text")


def gram_counts(rows: DataFrame) -> DataFrame:
    """``(lang, bucket, n)``: occurrences of hashed n-grams in the training rows of each language."""
    def work(chunk: pa.Table) -> Iterator[pa.RecordBatch]:
        langs = np.array(chunk.column("lang").to_pylist(), dtype=object)
        texts = np.array(chunk.column("text").to_pylist(), dtype=object)
        for lang in sorted(set(langs)):
            words, ids, _ = chunk_words(list(texts[langs == lang]))
            if not words:
                continue
            owner, place = gram_places(words)
            counts = np.bincount(place, weights=np.bincount(ids, minlength=len(words))[owner], minlength=BUCKETS)
            held = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(held), pa.string()), pa.array(held, pa.int64()),
                                              pa.array(counts[held].astype(np.int64))], names=["lang", "bucket", "n"])
    counted = map_chunks(rows, ["lang", "text"], text_bytes("text"), CHUNK_BYTES, work, "lang string, bucket bigint, n bigint")
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def bit_classifiers(counts: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Log odds of every bucket for each bit: the mean share of the languages on one side against the other's."""
    share = (counts + SMOOTHING) / (counts + SMOOTHING).sum(1, keepdims=True)
    up, down = (codes == 1).astype(float), (codes == -1).astype(float)
    return np.log((share.T @ up) / up.sum(0)) - np.log((share.T @ down) / down.sum(0))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a regression of signs ``y`` on ``x``, with a small ridge, by Newton's steps."""
    scale = float(np.sqrt(np.average(x * x, weights=weight))) or 1.0
    design, target, theta = np.column_stack([x / scale, np.ones(len(x))]), (y + 1) / 2, np.zeros(2)
    ridge = np.diag([1e-3, 1e-3])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        slope = design.T @ (weight * (p - target)) / weight.sum() + ridge @ theta
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design / weight.sum() + ridge
        theta -= np.clip(np.linalg.solve(curve, slope), -4, 4)
    return theta[0] / scale, theta[1]


def fit(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", lang_col: str = "lang",
        per_language: int = PER_LANGUAGE) -> EcocModel:
    """The model learned from the rows of ``docs`` that are not held out."""
    rows = stage(training_rows(docs, text_col, id_col, lang_col, per_language), "language-rows")
    found = gram_counts(rows).toArrow()
    names = found.column("lang").to_pylist()
    languages = sorted(set(names))
    number = {lang: i for i, lang in enumerate(languages)}
    counts = np.zeros((len(languages), BUCKETS))
    counts[[number[x] for x in names], found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    codes = code_matrix(len(languages))
    bits = codes.shape[1]
    grams = bit_classifiers(counts, codes) if bits else np.zeros((BUCKETS, 0))
    model = EcocModel(languages, codes, grams, np.ones(bits), np.zeros(bits), np.full(codes.shape, 1 / max(1, bits)))
    if not bits:
        return model

    def work(chunk: pa.Table) -> Iterator[pa.RecordBatch]:
        margins, known = model.margins(chunk.column("text").to_pylist())
        kept = pa.array(np.flatnonzero(known))
        yield pa.RecordBatch.from_arrays([chunk.column("lang").combine_chunks().take(kept), pa.array(list(margins[known]), pa.list_(pa.float64()))],
                                         names=["lang", "margins"])
    table = map_chunks(rows, ["lang", "text"], text_bytes("text"), CHUNK_BYTES, work, "lang string, margins array<double>").toArrow()
    label = np.array([number[x] for x in table.column("lang").to_pylist()])
    margins = np.array(table.column("margins").to_pylist())
    order = np.lexsort((*margins.T, label))  # sums do not depend on the order of arrival
    label, margins = label[order], margins[order]
    weight = 1 / np.bincount(label, minlength=len(languages))[label]
    for bit in range(bits):
        model.slope[bit], model.shift[bit] = _logistic(margins[:, bit], codes[label, bit].astype(float), weight)
    right = 1 / (1 + np.exp(-np.clip((margins * model.slope + model.shift) * codes[label], -30, 30)))
    trust = np.array([right[label == i].mean(0) for i in range(len(languages))])
    trust = np.clip(trust - 0.5, 0.01, None)
    model.trust = trust / trust.sum(1, keepdims=True)
    return model


def predict(docs: DataFrame, model: EcocModel, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all) of each row, and ``lang_pred``, ``score`` and ``ambiguous``; columns of these names get a suffix."""
    columns = docs.columns if keep is None else keep
    added = []
    for name in ("lang_pred", "score", "ambiguous"):
        added.append(unused(docs.select(*columns), name))

    def work(chunk: pa.Table) -> Iterator[pa.RecordBatch]:
        names, score, unsure = model.decode(chunk.column(text_col).to_pylist())
        yield pa.RecordBatch.from_arrays([*(chunk.column(c).combine_chunks() for c in columns), pa.array(names, pa.string()),
                                          pa.array(score), pa.array(unsure)], names=[*columns, *added])
    schema = docs.select(*columns).schema
    for name, kind in zip(added, ("string", "double", "boolean")):
        schema = schema.add(name, kind)
    return map_chunks(docs, list(dict.fromkeys([*columns, text_col])), text_bytes(text_col), CHUNK_BYTES, work, schema)
