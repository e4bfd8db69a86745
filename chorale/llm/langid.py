"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of hashed n-grams per language are summed with map-side combines over the learning rows; the log-probability
matrix (buckets times languages) is broadcast, and whole batches of texts are scored by numpy gathers and segment sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import checkpointed, quoted, ship, text_of, unused, without

#: Buckets of n-grams (a power of two) and the lengths of n-grams.
BUCKETS, LENGTHS = 1 << 15, (1, 2, 3)
#: Learning rows are a sample by hash of about this many (all, if there are fewer).
SAMPLE_ROWS = 20_000
#: Languages that the broadcast matrix may have: it takes BUCKETS x 4 bytes for each, so 262 MB for all.
MAX_LANGUAGES = 2000
SMOOTHING = 0.5
#: The score is the winner's share when an average n-gram's evidence counts this many times.
EVIDENCE = 30.0
UNDETERMINED = "und"
#: Log-probabilities that are gathered at once: code points of a block times languages.
_BLOCK_CELLS = 1 << 23
#: Multipliers of the rolling hash (odd 64-bit constants).
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_TOP = np.uint64(64 - (BUCKETS.bit_length() - 1))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def buckets_of(codes: np.ndarray) -> list[np.ndarray]:
    """Buckets of the n-grams that start at each code point, one array for each length."""
    wide = codes.astype(np.uint64)
    out = []
    for n in LENGTHS:
        if len(wide) < n:
            out.append(np.zeros(0, np.int64))
            continue
        h = np.full(len(wide) - n + 1, np.uint64(n) * _FACTORS[2], np.uint64)
        for i in range(n):
            h ^= (wide[i : len(wide) - n + 1 + i] + np.uint64(1)) * _FACTORS[i]
            h *= _FACTORS[0]
        out.append((h >> _TOP).astype(np.int64))
    return out


def codes_of(text: str) -> np.ndarray:
    """Code points of the lower-cased text between two spaces."""
    return np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), np.uint32)


class Model:
    """Log-probabilities of buckets given a language (buckets x languages), and log-priors."""

    def __init__(self, languages: list[str], counts: np.ndarray, documents: np.ndarray):
        self.languages = languages
        smooth = counts + SMOOTHING
        self.logs = np.log(smooth / smooth.sum(0, keepdims=True)).astype(np.float32)
        self.priors = np.log(documents / documents.sum()).astype(np.float64)
        self.block_chars = max(1, _BLOCK_CELLS // len(languages))

    def score(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The likeliest language (ties: the first by name) and its score for each text, null or without letters: und, 0."""
        names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        at = 0
        while at < len(texts):
            chosen, arrays, size = [], [], 0
            while at < len(texts) and (not chosen or size < self.block_chars):
                text = texts[at]
                if text and has_letter(text):
                    codes = codes_of(text)
                    chosen.append(at)
                    arrays.append(codes)
                    size += len(codes)
                at += 1
            if chosen:
                sums, grams = self._sums(arrays)
                totals = sums + self.priors
                best = totals.argmax(1)
                # Evidence is averaged so that long texts do not all score 1.
                mean = totals / np.maximum(grams, 1)[:, None]
                shares = 1 / np.exp((mean - mean.max(1, keepdims=True)) * np.minimum(EVIDENCE, grams)[:, None]).sum(1)
                for i, b, s in zip(chosen, best.tolist(), shares.tolist()):
                    names[i], scores[i] = self.languages[b], s
        return names, scores

    def _sums(self, arrays: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihoods and numbers of n-grams; a text longer than a block is summed in parts."""
        out, grams = np.zeros((len(arrays), len(self.languages))), np.zeros(len(arrays))
        short = [i for i, a in enumerate(arrays) if len(a) <= self.block_chars]
        if short:
            joined = np.concatenate([arrays[i] for i in short])
            ends = np.cumsum([len(arrays[i]) for i in short])
            starts = np.concatenate([[0], ends[:-1]])
            for n, found in zip(LENGTHS, buckets_of(joined)):
                logs = self.logs[found]
                across = ends[:-1, None] - np.arange(1, n)[None, :]  # n-grams that run from one text into the next
                logs[across.ravel()] = 0
                out[short] += np.add.reduceat(logs, starts, axis=0, dtype=np.float64)
                grams[short] += ends - starts - n + 1
        for i in set(range(len(arrays))) - set(short):
            for n, found in zip(LENGTHS, buckets_of(arrays[i])):
                grams[i] += len(found)
                for at in range(0, len(found), self.block_chars):
                    out[i] += self.logs[found[at : at + self.block_chars]].sum(0, dtype=np.float64)
        return out, grams


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per language the counts of all buckets in this task: (lang, bucket, n); bucket -1 has the documents."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            mine = counts.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
            mine[BUCKETS] += 1
            for found in buckets_of(codes_of(text or "")):
                mine[:BUCKETS] += np.bincount(found, minlength=BUCKETS)
    for lang, mine in counts.items():
        some = np.flatnonzero(mine)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(mine[some])], ["lang", "bucket", "n"])


def learn(rows: DataFrame, lang_col: str = "lang", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """A model of the rows with a language and a text; None if there are none.

    About ``sample_rows`` of them are taken by a hash of the text, so equal texts are in or out together.
    """
    ship(rows.sparkSession)
    labelled = rows.select(F.col(quoted(lang_col)).cast("string").alias("lang"), F.col(quoted(text_col)).alias("text")).where("lang is not null and text is not null")
    total = labelled.count()
    if total > sample_rows:
        share = int(sample_rows / total * (1 << 31))
        labelled = labelled.where(F.pmod(F.xxhash64("text", F.lit(7)), F.lit(1 << 31)) < share)
    summed = checkpointed(labelled.mapInArrow(_partial_counts, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    languages = sorted(r["lang"] for r in summed.where(F.col("bucket") == BUCKETS).limit(MAX_LANGUAGES + 1).collect())
    if not languages:
        return None
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    at = {lang: i for i, lang in enumerate(languages)}
    counts, documents = np.zeros((BUCKETS, len(languages))), np.zeros(len(languages))
    for lang, bucket, n in summed.toLocalIterator():  # at most BUCKETS + 1 rows for each language
        if bucket == BUCKETS:
            documents[at[lang]] = n
        else:
            counts[bucket, at[lang]] = n
    return Model(languages, counts, documents)


def held_out(id_col: str | Column) -> Column:
    """Whether a row is kept from learning: crc32 of the id as text leaves 2 modulo 4 (null ids are not)."""
    ident = F.col(quoted(id_col)) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def predict(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` plus ``lang_pred`` and ``score`` (0 to 1) of every whole text.

    A null text, or one without a letter, is ``und`` with score 0, and so is all if nothing could be learned.  Of equally
    likely languages the first by name counts.  A very long text is scored in parts whose evidence is added.  Repeated rows stay
    and agree.  Input columns called lang_pred or score (in any case) are replaced, also where one of them holds the text.
    An empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    names = without(docs, "lang_pred", "score").columns
    (judged,) = unused((*names, "lang_pred", "score"), "judged")
    columns = [F.col(quoted(c)) for c in names]
    if model is None:
        return docs.select(*columns, F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf(returnType=T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())]))
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            names, scores = shared.value.score(texts.to_pylist())
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    rows = docs.select(*columns, judge(text_of(F.col(quoted(text_col)))).alias(judged))
    return rows.select(*columns, F.col(f"{judged}.lang").alias("lang_pred"), f"{judged}.score")
