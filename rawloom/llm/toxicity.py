"""Toxicity: a weighted lexicon, matched by Aho-Corasick over folded text.

Folding puts letters in lower case, letters of other scripts that look like Latin ones in their
Latin form, digits and signs inside words (``m0r0n``) in the letters they stand for, and one blank
for anything else. The lexicon holds whole words and beginnings of words with weights learned from
labelled rows, besides a short list that is given; occurrences inside exception phrases do not
count. What is found, also per word of the text, becomes a score by a logistic fit.
"""

import math
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import ragged
from .frames import remainder, table, tidy

# Insults that need no labelled row, phrases in which they are harmless, and look-alikes.
GIVEN = (
    "arsehole asshole bastard bitch cretin dumbass fuck idiot imbecile jerk loser moron retard scum scumbag shithead "
    "abschaum arschloch dummkopf trottel wichser connard imbécile salaud gilipollas imbécil pendejo"
).split()
EXCEPTIONS = (
    "bitch and moan", "circus clown", "class clown", "clown fish", "jerk chicken", "jerk seasoning", "trash bag",
    "trash bin", "trash can", "trash collection", "trash compactor",
)
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "н": "h",
    "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o",
    "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ⅼ": "l", "ɑ": "a", "ɡ": "g",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}

#: Labelled rows of a label that are learned from: all of them up to so many, else about so many by a hash of the text.
TRAIN_ROWS = 20_000
STEMS = (4, 5, 6)
#: Entries that a task counts before it passes them on.
COUNTED = 50_000


@lru_cache(1)
def _fold_tables() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: its folded letter, or 0; the letter that a digit or sign stands for, or 0."""
    letter, stands = np.zeros(0x110000, np.uint32), np.zeros(0x110000, np.uint32)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            low = c.lower()
            low = low if len(low) == 1 else c
            letter[point] = ord(HOMOGLYPHS.get(low, low))
    letter[0xFF21:0xFF3B] = letter[0xFF41:0xFF5B] = np.arange(97, 123)  # full-width Latin
    for c, to in SUBSTITUTES.items():
        stands[ord(c)] = ord(to)
    return letter, stands


def folded(points: np.ndarray, endings: bool = False) -> np.ndarray:
    """Letters of the texts, and blanks (32). Digits and signs count if a letter follows them, straight or after others.

    With ``endings`` those count too that end a word after a letter (``a$$``); otherwise these are blanks (``idiot1``).
    """
    letter, stands = _fold_tables()
    out, sub = letter[points], stands[points]
    if sub.any():
        plain = (out == 0) & (sub != 0)
        # what follows the run of substitutes that a position is in
        n = len(points)
        nxt = np.where(plain, n, np.arange(n))
        nxt = np.minimum.accumulate(nxt[::-1])[::-1]
        follows = np.zeros(n, bool)
        inside = nxt < n
        follows[inside] = out[nxt[inside]] != 0
        if endings:
            before = np.maximum.accumulate(np.where(plain, -1, np.arange(n)))
            follows |= (before >= 0) & (out[before] != 0)
        out = np.where(plain & follows, sub, out)
    out[out == 0] = 32
    return out


def _texts(column, endings: bool = False):
    """(row, folded text with a blank at either end) of a column's texts; ``endings`` adds the same with endings if it has any."""
    for i, j, data, offsets in ragged.chunks(column):
        points, at = ragged.code_points(data, offsets)
        ends = np.zeros(len(points) + len(at), np.uint32)  # a separator after each text, so that folding stays inside
        place = np.arange(len(points)) + np.repeat(np.arange(len(at) - 1), np.diff(at))
        ends[place] = points
        plain = folded(ends)
        if not endings:
            whole = plain.tobytes().decode("utf-32-le")
            yield from ((i + k, f" {whole[a + k : b + k]} ") for k, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())))
            continue
        ending = folded(ends, endings=True)
        other = np.concatenate([[0], np.cumsum(plain != ending)])
        whole, ended = (x.tobytes().decode("utf-32-le") for x in (plain, ending))
        for k, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
            a, b = a + k, b + k
            yield i + k, f" {whole[a:b]} ", f" {ended[a:b]} " if other[b] > other[a] else None


@dataclass
class Lexicon:
    """Weights of patterns: `` word `` for a whole word, `` stem`` for the beginning of longer ones."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS
    fit: tuple[float, ...] = (-3.0, 1.0, 0.5, 0.5)

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for phrase in self.exceptions:
            found.add_word(f" {phrase} ", (len(phrase) + 2, 0.0))
        for pattern, weight in self.weights.items():
            found.add_word(pattern, (len(pattern), weight))
        found.make_automaton()
        return found


def hits(automaton, *texts: str | None) -> list[float]:
    """The largest weight found at each word that begins an occurrence outside exception phrases, in any of a text's foldings."""
    if not len(automaton):
        return []
    best: dict[int, float] = {}
    spared = []
    for text in filter(None, texts):
        for end, (size, weight) in automaton.iter(text):
            begin = end - size + 1
            if weight:
                best[begin] = max(best.get(begin, 0.0), weight)
            else:
                spared.append((begin, end))
    if spared:
        best = {b: w for b, w in best.items() if not any(x <= b < y for x, y in spared)}
    return list(best.values())


def measures(found: list[float], n_words: int) -> tuple[float, float, float]:
    """Strongest hit, all hits, and hits per hundred words (each on a slow scale)."""
    total = sum(found)
    return max(found, default=0.0), math.log1p(total), math.log1p(100 * total / max(n_words, 1))


def _word_count(text: str) -> int:
    return len(text.split())


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic fit of points that stand for ``n`` rows each, by Newton's method; the constant is not held back."""
    x = np.column_stack([np.ones(len(x)), x])
    w, hold = np.zeros(x.shape[1]), np.diag([1e-6, *[ridge] * (x.shape[1] - 1)])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + hold, x.T @ (n * (y - p)) - hold @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _entries(text: str) -> set[str]:
    """Words of a folded text and the beginnings of longer ones, as patterns."""
    words = set(text.split())
    out = {f" {w} " for w in words if len(w) > 2}
    for n in STEMS:
        out.update(f" {w[:n]}" for w in words if len(w) > n)
    return out


def train(rows: DataFrame, text: str = "text", label: str = "label", train_rows: int = TRAIN_ROWS,
          support: int = 5, least: float = 2.5) -> Lexicon:
    """Learn weights and scores from rows labelled 0 or 1; equal texts count once.

    About ``train_rows`` rows of each label are read, whole texts. An entry needs ``support`` texts
    labelled 1 and a smoothed log ratio of ``least`` between the labels, less two standard errors; all that
    have both are in the lexicon, whose size the rows learned from bound. Without rows of both labels,
    the given list and its default scores stay.
    """
    given = {}
    for word in GIVEN:
        folded_word = folded(np.frombuffer(word.encode("utf-32-le"), np.uint32)).tobytes().decode("utf-32-le")
        given[f" {folded_word} "] = 3.0
    lexicon = Lexicon(dict(given))
    rows = rows.select(F.col(text).alias("text"), F.col(label).cast("int").alias("label")).where("text IS NOT NULL AND label IN (0, 1)")
    rows = rows.withColumn("draw", F.xxhash64("text"))
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return lexicon
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, train_rows / n))])
    scale = 1 << 20
    drawn = (F.col("draw") % scale + scale) % scale < share[F.col("label")] * scale
    rows = rows.where(drawn).groupBy("draw", "label").agg(F.first("text").alias("text")).select("text", "label").cache()

    def counted(wanted):
        keep = None if wanted is None else set(wanted.value)

        def packed(seen):
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["entry", "n"])

        def count(batches):
            seen = Counter()
            for batch in batches:
                for _, *own in _texts(batch.column(0), endings=True):
                    found = set().union(*map(_entries, filter(None, own)))
                    seen.update(found if keep is None else found & keep)
                    seen[""] += 1
                    if len(seen) > COUNTED:  # Spark adds up what is sent in parts
                        yield packed(seen)
                        seen.clear()
            yield packed(seen)

        return count

    def total(only: int, wanted=None):
        counts = rows.where(F.col("label") == only).select("text").mapInArrow(tidy(counted(wanted)), "entry string, n long")
        return counts.groupBy("entry").agg(F.sum("n").alias("n"))

    try:
        # what the bounded number of texts labelled 1 share; then how often the others have these
        strong = total(1).where(F.col("n") >= support).orderBy(F.desc("n"), "entry").toArrow()
        toxic = dict(zip(strong["entry"].to_pylist(), strong["n"].to_pylist()))
        n_toxic = toxic.pop("", 0)
        wanted = rows.sparkSession.sparkContext.broadcast(list(toxic))
        plain = total(0, wanted).toArrow()
        clean = dict(zip(plain["entry"].to_pylist(), plain["n"].to_pylist()))
        n_clean = clean.pop("", 0)
        if n_toxic and n_clean:
            ratio = {
                e: math.log((n + 0.5) / (n_toxic + 1)) - math.log((clean.get(e, 0) + 0.5) / (n_clean + 1))
                for e, n in toxic.items()
            }
            # evidence: the ratio less two standard errors
            sure = {e: r - 2 * math.sqrt(1 / (toxic[e] + 0.5) + 1 / (clean.get(e, 0) + 0.5)) for e, r in ratio.items()}
            spare = _spare(toxic, ratio)
            chosen = sorted((e for e in ratio if sure[e] >= least and e not in spare), key=lambda e: (-sure[e], e))
            lexicon.weights.update({f"{e[:-1]}s ": round(sure[e], 6) for e in chosen if e.endswith(" ") and not e.endswith("s ")})  # plurals
            lexicon.weights.update({e: round(sure[e], 6) for e in chosen})
            shared = rows.sparkSession.sparkContext.broadcast(lexicon)

            def measured(batches):
                automaton = shared.value.automaton()
                for batch in batches:
                    own = [measures(hits(automaton, *t), _word_count(t[0])) for _, *t in _texts(batch.column(0), endings=True)]
                    yield pa.RecordBatch.from_arrays([batch.column(1), *[pa.array([m[k] for m in own], pa.float64()) for k in range(3)]], ["label", "a", "b", "c"])

            # most texts have no hit at all: equal points count once, with their number
            points = rows.mapInArrow(tidy(measured), "label int, a double, b double, c double").groupBy("a", "b", "c", "label")
            points = points.agg(F.count("*").alias("n")).toArrow().sort_by([(c, "ascending") for c in ("a", "b", "c", "label")])
            x = np.column_stack([points[c].to_numpy() for c in "abc"])
            y, n = (points[c].to_numpy().astype(float) for c in ("label", "n"))
            lexicon.fit = tuple(np.round(_logistic(x, y, n), 6).tolist())
    finally:
        rows.unpersist()
    return lexicon


def _spare(texts: dict[str, int], ratio: dict[str, float], most: float = 0.9) -> set[str]:
    """Entries that others stand for: a beginning of which nearly all texts have one and the same
    longer entry, and longer entries that are a small part of a beginning which says as much."""
    out = set()
    for entry, n in texts.items():
        stem = entry.rstrip(" ")
        for shorter in (stem[: k + 1] for k in STEMS if k + 1 < len(entry)):
            if shorter != entry and shorter in texts:
                if n >= most * texts[shorter]:
                    out.add(shorter)
                elif ratio[shorter] >= ratio[entry] - 0.25:
                    out.add(entry)
    return out


def toxicity(docs: DataFrame, lexicon: Lexicon, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """Adds ``score`` (0 to 1) and ``predicted`` (1 from the threshold on) to every row; columns of these names are replaced.

    NULL and empty texts have the score of a text without hits. Equal texts get equal scores; an
    empty table stays empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    kept = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    names = [f"c{i}" for i in range(len(kept))]
    fields = T.StructType([T.StructField(n, docs.schema[c].dataType) for n, c in zip(names, kept)]).add("score", "double")
    place = kept.index(text)

    def scored(batches):
        own = shared.value
        automaton = own.automaton()
        constant, *slopes = own.fit
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for i, t, ended in _texts(batch.column(place), endings=True):
                found = hits(automaton, t, ended)
                x = measures(found, _word_count(t)) if found else (0.0, 0.0, 0.0)
                z = constant + sum(a * b for a, b in zip(slopes, x))
                out[i] = 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], fields.names)

    found = docs.select(*[F.col(f"`{c}`").alias(n) for n, c in zip(names, kept)]).mapInArrow(tidy(scored), fields)
    found = found.select(*[F.col(n).alias(c) for n, c in zip(names, kept)], "score")
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def labelled(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Texts and labels of the rows that may be learned from, about ``train_rows`` of each label.

    They are drawn from the labels, by a hash of the key, before texts are looked up; so the list that
    is broadcast has a fixed size, and texts aren't shuffled. Repeated labels of a key count once.
    """
    usable = labels.where((remainder(F.col("doc_id"), 5) != 0) & F.col("toxic").isin(0, 1))
    usable = usable.select("doc_id", F.col("toxic").cast("int").alias("label")).distinct()
    sizes = {r["label"]: r["n"] for r in usable.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for label, n in sizes.items():
        share = F.when(F.col("label") == label, F.lit(min(1.0, train_rows / n))).otherwise(share)
    scale = 1 << 20
    drawn = usable.where((F.xxhash64("doc_id") % scale + scale) % scale < share * scale)
    texts = docs.select("doc_id", "text").where(remainder(F.col("doc_id"), 5) != 0)
    return texts.join(F.broadcast(drawn), "doc_id").select("text", "label")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = train(labelled(docs, table(spark, sf_dir, "labels")))
    held_out = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    return toxicity(docs.withColumn("held_out", held_out), lexicon).select("doc_id", "held_out", "score", "predicted")
