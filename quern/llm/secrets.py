"""Secret scans: candidates found by pattern, false positives removed by a random forest.

Candidates are long runs of key characters, and whatever is assigned to a name that announces a secret from four characters on
(a run inside such a value is not a finding of its own, unless it is an issued key or the value a URL). Their features are length, character transitions (changes of
character class, and how likely the letters follow each other in the corpus' words), dictionary coverage (greatest part of the
letters that corpus words cover), path (slashes, and words of the document's path) and neighbouring words.
The forest is Spark's, trained on all labelled findings that are not held out.

The dictionary holds the words that make up at least ``min_rate`` of all words of the corpus (and stand ``MIN_COUNT`` times), and so at
most ``1 / min_rate`` words at any size. Words and letter pairs are counted over all texts, however these are partitioned. A finding gives its place in the text, so repeated rows give repeated findings; null
and empty texts have none. With labels of one kind only, that kind is predicted.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.text import map_chunks, text_bytes
from quern.session import stage

MIN_RATE = 2e-6
MIN_COUNT = 3
CHUNK_BYTES = 8 << 20
TREES = 30
DEPTH = 8
SEED = 11

_RUN = re.compile(r"[A-Za-z0-9+/_-]{12,}={0,2}")
_WORD = re.compile(r"[a-z]{2,15}")
# A name (with the quote that closes it), what links it to the value, and the quote that opens the value.
_BEFORE = re.compile(r"((?:[A-Za-z_-][A-Za-z0-9_.-]*+)?)(?:[\"'`\])\\]*)(\s*(?:=>|:=|={1,3}|:)\s*(?:[bruf]{1,2}(?=[\"']))?|\s+)?([\"'`(\\]*)\Z", re.IGNORECASE)
# Words that announce a secret, words of paths without real ones, and issuers' key formats.
_ANNOUNCE = ("password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "api-key", "credential", "bearer")
_HARMLESS = ("test", "example", "sample", "docs", "spec", "mock")
# What follows an announcing word when a value is assigned: the rest of the name, the link, and the value, quoted or bare.
_ASSIGNED = re.compile(r"[A-Za-z0-9_.-]{0,40}[\"'`\])\\]*\s{0,20}(?:=>|:=|={1,3}|:)\s{0,20}(?:[bruf]{1,2}(?=[\"']))?"
                       r"(?:[(\\]*[\"'`]([^\s\"'`\\]{4,})|\(*((?:(?!&\w+=)[^\s\"'`,;(){}<>\[\]\\]){4,}))", re.IGNORECASE)
_WORDLIKE = re.compile(r"(?=.*[AEIOUYaeiouy])(?!.*[b-df-hj-np-tv-xzB-DF-HJ-NP-TV-XZ]{6})[A-Z]?[a-z]*|(?=.*[AEIOUY])(?!.*[B-DF-HJ-NP-TV-XZ]{6})[A-Z]+")
_HUMPS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[A-Z]")
_SHORT = re.compile(r"[a-z]{1,4}|[A-Z]{1,4}")
_PLACEHOLDER = re.compile(r"(.)\1*|[\W_]+|\$\{?\w+\}?|%\w+%|\{+[\w.-]+\}+|\[?redacted\]?|(your|my|some|the)[_-]?[a-z_-]*(password|passwd|pwd|secret|token|key|credential)[a-z_-]*"
                          r"|change[_-]?me|place[_-]?holder|(ex|s)ample[a-z_-]*|dummy[a-z_-]*|none|null|undefined|todo|x{3,}[a-z0-9_-]*|(0?1234567890?)+", re.IGNORECASE)
_ISSUED = re.compile(r"(AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abpr]-[A-Za-z0-9-]{20,}|AIza[0-9A-Za-z_-]{35}|sk_live_[0-9A-Za-z]{24,}")

FEATURES = ("length", "digits", "upper", "lower", "class_changes", "distinct", "letter_odds", "covered", "slashes", "path_depth", "harmless_path",
            "announced", "assigned", "quoted", "known_before", "known_after")


@dataclass
class Dictionary:
    words: frozenset
    odds: np.ndarray

    @staticmethod
    def of(words: Iterable[str], pair_counts: dict[str, int]) -> Dictionary:
        pairs = np.full((26, 26), 0.5)
        for (a, b), n in pair_counts.items():
            pairs[ord(a) - 97, ord(b) - 97] += n
        return Dictionary(frozenset(words), np.log(pairs / pairs.sum(1, keepdims=True)))


def corpus_words(docs: DataFrame, text_col: str = "text", min_rate: float = MIN_RATE) -> Dictionary:
    def work(chunk: pa.Table) -> Iterator[pa.RecordBatch]:
        counts = Counter()
        for text in chunk.column(text_col).to_pylist():
            counts.update(_WORD.findall((text or "").lower()))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
    found = map_chunks(docs, [text_col], text_bytes(text_col), CHUNK_BYTES, work, "word string, n bigint")
    counts = stage(found.groupBy("word").agg(F.sum("n").alias("n")), "words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    often = counts.filter(F.col("n") >= max(MIN_COUNT, min_rate * total)).select("word")
    places = counts.filter(F.length("word") > 1).withColumn("at", F.explode(F.sequence(F.lit(1), F.length("word") - 1)))
    pairs = places.groupBy(F.expr("substring(word, at, 2)").alias("pair")).agg(F.sum("n").alias("n"))
    return Dictionary.of((r[0] for r in often.toLocalIterator()), dict(pairs.collect()))


def coverage(letters: str, words: frozenset) -> float:
    """Greatest share of the letters that words of at least three letters cover without overlap."""
    best = [0] * (len(letters) + 1)
    for end in range(1, len(letters) + 1):
        best[end] = best[end - 1]
        for size in range(3, min(15, end) + 1):
            if best[end - size] + size > best[end] and letters[end - size:end] in words:
                best[end] = best[end - size] + size
    return best[-1] / len(letters) if letters else 0.0


def _class(code: int) -> int:
    return 0 if 48 <= code <= 57 else 1 if 65 <= code <= 90 else 2 if 97 <= code <= 122 else 3


_CLASSES = np.array([_class(c) for c in range(128)])


def finding_features(text: str, start: int, end: int, path: str | None, known: Dictionary) -> list[float]:
    run = text[start:end]
    codes = np.frombuffer(run.encode(), np.uint8)
    kinds = _CLASSES[np.minimum(codes, 127)]
    share = np.bincount(kinds, minlength=4) / len(codes)
    lower = run.lower()
    letters = np.frombuffer(lower.encode(), np.uint8).astype(int) - 97
    pair = (letters[:-1] >= 0) & (letters[:-1] < 26) & (letters[1:] >= 0) & (letters[1:] < 26)
    odds = float(known.odds[letters[:-1][pair], letters[1:][pair]].mean()) if pair.any() else -6.0
    name, link, quote = _BEFORE.search(text, max(0, start - 60), start).groups()
    after = re.match(r"\W*(\w*)", text[end:end + 40]).group(1).lower()
    name, where = name.lower(), (path or "").lower()
    return [float(np.log(len(run))), share[0], share[1], share[2], float((kinds[1:] != kinds[:-1]).mean()), len(set(run)) / len(run), odds,
            coverage(re.sub("[^a-z]", "", lower), known.words), run.count("/") / len(run), float(where.count("/")),
            float(any(w in where for w in _HARMLESS)), float(any(w in name for w in _ANNOUNCE)), float(bool((link or "").strip())),
            float(bool(quote)), float(name in known.words), float(after in known.words)]


def candidates(text: str) -> list[tuple[int, int]]:
    """Places of long runs, and of values assigned to an announcing name."""
    low, values = text.replace("\u0130", "i").lower(), set()
    for word in _ANNOUNCE:
        at = low.find(word)
        while at >= 0:
            found = _ASSIGNED.match(text, at + len(word))
            if found:
                start, end = found.span(found.lastindex)
                while found.lastindex == 2 and text[end - 1] in ".:":
                    end -= 1
                if end - start >= 4:
                    values.add((start, end))
            at = low.find(word, at + len(word))
    covers, spans, reach = sorted(values), set(values), 0
    for m in _RUN.finditer(text) if covers else ():
        while reach < len(covers) and covers[reach][1] < m.end():
            reach += 1
        inside = reach < len(covers) and covers[reach][0] <= m.start()
        if not inside or "://" in text[slice(*covers[reach])] or _ISSUED.fullmatch(m.group()):
            spans.add(m.span())
    return sorted(spans) if covers else [m.span() for m in _RUN.finditer(text)]


def reads_as_words(run: str) -> bool:
    """Words, identifiers and paths: pieces of letters whose humps have vowels (or of at most four letters), and whole numbers of at most eight digits."""
    word = False
    for piece in re.split(r"[^A-Za-z0-9]+", run) if run.isascii() else ():
        if piece.isdigit() and len(piece) <= 8:
            continue
        humps = _HUMPS.findall(piece) if piece.isalpha() else []
        if humps and all(map(_WORDLIKE.fullmatch, humps)):
            word = word or max(map(len, humps)) > 2
        elif piece and not _SHORT.fullmatch(piece):
            return False
    return word


def labelled_by_format(text: str, start: int, end: int) -> int | None:
    """1 for issued key formats and for values with digits that are assigned to an announced secret, 0 for placeholders and what
    reads as words or a path, null without evidence of either kind and where both kinds stand against each other."""
    name, link, quote = _BEFORE.search(text, max(0, start - 60), start).groups()
    run = text[start:end]
    if _ISSUED.fullmatch(run):
        return 1
    if _PLACEHOLDER.fullmatch(run):
        return 0
    assigned = bool((link or "").strip()) and any(w in name.lower() for w in _ANNOUNCE)
    if assigned and "://" not in run and any(c.isdigit() for c in run):
        return 1 if len(run) >= 12 or not run.isdigit() else None
    return 0 if reads_as_words(run) and not (assigned and quote) else None


def findings(docs: DataFrame, known: Dictionary, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source", label=labelled_by_format) -> DataFrame:
    """``(doc_id, start, n_chars, candidate, label, features)`` per candidate; ``label`` judges ``(text, start, end)``, null is not labelled."""
    shared = docs.sparkSession.sparkContext.broadcast(known)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(path_col).cast("string").alias("path"))
    kind = dict(rows.dtypes)["doc_id"]

    def work(chunk: pa.Table) -> Iterator[pa.RecordBatch]:
        words, ids, spans, runs, labels, numbers = shared.value, [], [], [], [], []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, chunk.schema.field("doc_id").type), pa.array([a for a, _ in spans], pa.int64()), pa.array([b - a for a, b in spans], pa.int64()),
                 pa.array(runs, pa.string()), pa.array(labels, pa.int32()), pa.array(numbers, pa.list_(pa.float64()))],
                names=["doc_id", "start", "n_chars", "candidate", "label", "features"])
        for doc_id, text, path in zip(*(chunk.column(c).to_pylist() for c in ("doc_id", "text", "path"))):
            for start, end in candidates(text or ""):
                ids.append(doc_id)
                spans.append((start, end))
                runs.append(text[start:end])
                labels.append(label(text, start, end))
                numbers.append(finding_features(text, start, end, path, words))
            if len(ids) >= 10_000:
                yield batch()
                ids, spans, runs, labels, numbers = [], [], [], [], []
        if ids:
            yield batch()
    return map_chunks(rows, ["doc_id", "text", "path"], text_bytes("text"), CHUNK_BYTES, work,
                      f"doc_id {kind}, start bigint, n_chars bigint, candidate string, label int, features array<double>")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source", label=labelled_by_format,
         trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> DataFrame:
    """``(doc_id, start, n_chars, candidate, held_out, label, score, predicted)`` of all candidates.

    Findings whose crc32 of the candidate mod 5 is 0 are held out of training, so that copies of a candidate are on one side.
    """
    found = findings(docs, corpus_words(docs, text_col), id_col, text_col, path_col, label)
    found = stage(found.withColumn("held_out", F.crc32("candidate") % 5 == 0), "findings")
    training = found.filter("label IS NOT NULL AND NOT held_out").select(F.col("label").cast("double").alias("label"), array_to_vector("features").alias("x"))
    kinds = [r[0] for r in training.select("label").distinct().limit(2).collect()]
    columns = ["doc_id", "start", "n_chars", "candidate", "held_out", "label"]
    if len(kinds) < 2:
        scored = found.select(*columns, F.lit(kinds[0] if kinds else 0.0).alias("score"))
    else:
        forest = RandomForestClassifier(featuresCol="x", numTrees=trees, maxDepth=depth, seed=seed).fit(training)
        scored = forest.transform(found.withColumn("x", array_to_vector("features"))).select(*columns, vector_to_array("probability")[1].alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
