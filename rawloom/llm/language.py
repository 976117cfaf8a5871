"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts become arrays of code points in lower case with one blank for every character that is no
letter. Each n-gram is hashed to one of ``2**BITS`` features. Training counts features by language
in Spark; the matrix of log probabilities (languages x features, a fixed size) goes to all tasks,
which add up the rows of each text's features in numpy.
"""

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import ragged
from .frames import free_name, remainder, table

BITS = 16
SIZES = (1, 2, 3)
#: Training rows of a language: all of them up to so many, else about so many, chosen by a hash of the text.
TRAIN_ROWS = 20_000
#: Code points that are scored together; longer texts are scored in pieces that overlap.
PIECE = 1 << 20
UNKNOWN = "und"


@lru_cache(1)
def _letters() -> np.ndarray:
    """For each code point its lower case if it is a letter, else a blank."""
    out = np.full(0x110000, 32, np.uint32)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            low = c.lower()
            out[point] = ord(low) if len(low) == 1 else point
    return out


def features(points: np.ndarray, size: int) -> np.ndarray:
    """Hashed n-grams of ``size`` characters, by the position at which they begin."""
    n = len(points) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    x = np.full(n, size, np.uint32)
    for k in range(size):
        x = (x ^ points[k : k + n]) * np.uint32(0x9E3779B1)
        x ^= x >> np.uint32(15)
    return ((x * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS)).astype(np.int64)


def ngrams(points: np.ndarray, at: np.ndarray):
    """(features, offsets of each text) for each size; none crosses texts."""
    for size in SIZES:
        found = features(points, size)
        whole = np.ones(len(found), bool)
        for k in range(1, size):  # begins in the last characters of a text
            last = at[1:] - k
            whole[last[(last >= 0) & (last < len(found))]] = False
        # texts shorter than the n-gram also cover places before their own begin
        short = np.flatnonzero(np.diff(at) < size)
        for i in short:
            whole[at[i] : at[i + 1]] = False
        ends = np.concatenate([[0], np.cumsum(whole)])
        yield found[whole], ends[np.minimum(at, len(found))]


def _pieces(points: np.ndarray, at: np.ndarray):
    """Runs of texts as (first text, code points, offsets); a very long text comes in several pieces.

    Pieces of one text overlap by the longest n-gram less one, so that each n-gram of the longest
    size comes once; shorter ones come twice at the few seams.
    """
    i, n = 0, len(at) - 1
    while i < n:
        j = int(np.searchsorted(at, at[i] + PIECE, "right")) - 1
        if j > i:
            yield i, points[at[i] : at[j]], at[i : j + 1] - at[i]
            i = j
        else:
            for a in range(at[i], at[i + 1], PIECE):
                part = points[a : min(a + PIECE + max(SIZES) - 1, at[i + 1])]
                yield i, part, np.array([0, len(part)])
            i += 1


def _letters_of(column):
    for i, j, data, offsets in ragged.chunks(column):
        points, at = ragged.code_points(data, offsets)
        yield i, j, _letters()[points], at


@dataclass(frozen=True)
class Model:
    """Learned languages in order, and log probabilities as (features, languages)."""

    languages: tuple[str, ...]
    prior: np.ndarray
    weights: np.ndarray

    def predict(self, column) -> tuple[list[str], np.ndarray]:
        names, scores = [], []
        for i, j, points, at in _letters_of(column):
            total = np.tile(self.prior, (j - i, 1))
            seen = np.zeros(j - i, bool)
            for first, part, offsets in _pieces(points, at):
                letter = np.concatenate([[0], np.cumsum(part != 32)])[offsets]
                seen[first : first + len(offsets) - 1] |= np.diff(letter) > 0
                for found, ends in ngrams(part, offsets):
                    filled = np.flatnonzero(np.diff(ends))
                    if len(filled) and len(self.languages):
                        total[first + filled] += np.add.reduceat(self.weights[found], ends[filled], axis=0, dtype=np.float64)
            if not self.languages:
                seen[:] = False
            known = np.flatnonzero(seen)
            best, score = np.zeros(j - i, np.int64), np.zeros(j - i)
            if len(known):
                own = total[known]
                best[known] = own.argmax(axis=1)
                score[known] = 1 / np.exp(own - own.max(axis=1, keepdims=True)).sum(axis=1)
            names += [self.languages[b] if s else UNKNOWN for b, s in zip(best, seen)]
            scores.append(score)
        return names, np.concatenate(scores) if scores else np.zeros(0)


def train(rows: DataFrame, text: str = "text", lang: str = "lang", train_rows: int = TRAIN_ROWS, smoothing: float = 0.5) -> Model:
    """Fit on the distinct texts of each language. At most about ``train_rows`` of each are read, whole texts.

    All languages are equally likely beforehand, however many texts they have.
    """
    rows = rows.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    rows = rows.withColumn("hash", F.xxhash64("text"))
    sizes = {r["lang"]: r["n"] for r in rows.select("lang", "hash").distinct().groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model((), np.zeros(0), np.zeros((1 << BITS, 0), np.float32))
    names = tuple(sorted(sizes))
    share = F.create_map(*[F.lit(x) for n in names for x in (n, min(1.0, train_rows / sizes[n]))])
    number = F.create_map(*[F.lit(x) for i, n in enumerate(names) for x in (n, i)])
    draw = F.pmod("hash", F.lit(1 << 20))
    # copies collapse in their tasks before the shuffle
    chosen = rows.where(draw < share[F.col("lang")] * F.lit(1 << 20)).dropDuplicates(["lang", "hash"]).select("text", number[F.col("lang")].alias("lang"))

    def counted(batches):
        counts = np.zeros((len(names), 1 << BITS), np.int64)
        for batch in batches:
            langs = batch.column(1).to_numpy(zero_copy_only=False)
            for i, j, points, at in _letters_of(batch.column(0)):
                for first, part, offsets in _pieces(points, at):
                    for found, ends in ngrams(part, offsets):
                        owner = np.repeat(langs[i + first : i + first + len(ends) - 1].astype(np.int64), np.diff(ends))
                        counts += np.bincount(owner * (1 << BITS) + found, minlength=counts.size).reshape(counts.shape)
        where = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(where, pa.int64()), pa.array(counts.ravel()[where], pa.int64())], ["cell", "n"])

    # at most languages x features cells, however large the table
    cells = chosen.mapInArrow(counted, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(len(names) << BITS)
    counts[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    counts = counts.reshape(len(names), -1) + smoothing
    # every n-gram is one draw; longer texts overlap less than they look, which the scores leave out
    weights = np.log(counts / counts.sum(axis=1, keepdims=True))
    return Model(names, np.full(len(names), -np.log(len(names))), np.ascontiguousarray(weights.T.astype(np.float32)))


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``score`` (the prediction's posterior) to every row; columns of these names are replaced.

    A text that is NULL, empty or without any letter gets ``und`` and 0.0, as does every text if
    nothing could be learned. Of equally likely languages the first by name wins. Equal texts get
    equal answers; an empty table stays empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())]))
    def predict(series: pd.Series) -> pd.DataFrame:
        names, scores = shared.value.predict(pa.array(series, pa.large_string()))
        return pd.DataFrame({"lang": names, "score": scores})

    found = free_name(docs, "found")
    return docs.withColumn(found, predict(F.col(text))).withColumns({"lang_pred": F.col(f"{found}.lang"), "score": F.col(f"{found}.score")}).drop(found)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    part = remainder(F.col("doc_id"), 3)
    model = train(docs.where(part != 1))
    held_out = F.coalesce(part == 1, F.lit(False)).alias("held_out")
    return identify(docs.select("doc_id", held_out, "text"), model).select("doc_id", "held_out", "lang_pred", "score")
