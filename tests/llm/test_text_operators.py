import base64
import hashlib
import math
from collections import Counter

import brute
import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
from pyspark.sql import functions as F

from rawloom.llm import byte_bpe, decontaminate, language, near_duplicates, ragged, repeats, token_counts, toxicity
from rawloom.llm.frames import vocabulary

JSON, RANKS = vocabulary("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.tiktoken")


def expected_counts(texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(JSON)
    return [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def expected_ids(text):
    import public_tokenizers
    import tiktoken

    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return [plain.encode_ordinary(t or "") for t in text]


def test_token_counts(odd, odd_rows, documents, rows):
    for df, own in ((odd, odd_rows), (documents, rows)):
        got = token_counts.token_counts(df, JSON).collect()
        assert [(r.doc_id, r.n_tokens) for r in got] == list(zip([k for k, _ in own], expected_counts([t for _, t in own])))
        assert all(r.n_bytes == len((r.text or "").encode()) and r.over_limit == (r.n_tokens > 1024) for r in got)
    assert "found" in token_counts.token_counts(odd, JSON).columns
    assert token_counts.token_counts(odd.limit(0), JSON).count() == 0


def test_merges_of_overlapping_pairs():
    counter = token_counts.Counter(JSON)
    import pyarrow as pa

    texts = ["a" * n for n in range(1, 70)] + ["ab" * 40, "\n" * 9 + "x", "it's '' 's I'll we've'x  'd", "1234567890" * 20]
    data, offsets = ragged.flat(pa.array(texts))
    assert counter.counts(data, offsets).tolist() == expected_counts(texts)


def test_byte_bpe(odd, odd_rows, documents, rows):
    for df, own in ((odd, odd_rows), (documents, rows)):
        got = [tuple(r) for r in byte_bpe.round_trip(df, RANKS).collect()]
        ids = expected_ids([t for _, t in own])
        raw = [b"".join(i.to_bytes(4, "little") for i in x) for x in ids]
        assert got == [
            (k, len(x), hashlib.sha256(r).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for (k, t), x, r in zip(own, ids, raw)
        ]


def test_encode_with_spans_and_decode(odd, odd_rows):
    encoded = byte_bpe.encode(odd, RANKS, spans=True)
    got = encoded.collect()
    assert [list(r.ids) for r in got] == expected_ids([t for _, t in odd_rows])
    for (_, text), r in zip(odd_rows, got):
        assert len(r.starts) == len(r.ids) == len(r.ends)
        if r.ids:
            assert r.starts[0] == 0 and r.ends[-1] == len(text) and all(a < b for a, b in zip(r.starts, r.ends))
    assert [r.decoded for r in byte_bpe.decode(encoded, RANKS).collect()] == [(t or "").encode() for _, t in odd_rows]


def test_near_duplicates_of_documents(documents, rows):
    for percent in (80, 85):
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates.near_duplicates(documents, percent).collect()}
        assert got == brute.near_duplicates(rows, percent)


def test_near_duplicates_of_odd_rows(odd, odd_rows):
    got = near_duplicates.near_duplicates(odd).collect()
    assert len(got) == len(odd_rows)
    want = brute.near_duplicates([(k, t) for k, t in dict(odd_rows).items() if k], 85)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id} == want
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    assert near_duplicates.near_duplicates(odd.limit(0)).count() == 0


def test_near_duplicates_in_chains(spark):
    """A large group of variants of one text, and a chain in which only neighbours are similar enough."""
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join([*base[:60], f"x{i}", *base[61:]])) for i in range(60)]
    chain = [f"c{i}" for i in range(200)]
    rows += [(1000 - i, " ".join(chain[4 * i : 4 * i + 120])) for i in range(20)]
    rows += [(2000 + i, " ".join([*base[:30], *[f"y{i}_{j}" for j in range(40)]])) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates.near_duplicates(df).collect()}
    assert got == brute.near_duplicates(rows, 85)


def test_near_duplicates_in_large_buckets(spark, monkeypatch):
    """Variants of a variant that is no copy of the first text, with buckets of shared shingles that count as large."""
    monkeypatch.setattr(near_duplicates, "BUCKET", 12)
    base = [f"w{i}" for i in range(150)]
    second = [*base[:40], *[f"v{i}" for i in range(12)], *base[52:]]
    third = [*base[:90], *[f"u{i}" for i in range(9)], *base[99:]]
    rows = []
    for k, text in enumerate((base, second, third)):
        for i in range(25):
            place = 3 + 5 * i
            rows.append((100 * k + i, " ".join([*text[:place], f"x{k}_{i}", *text[place + 1 :]])))
    rows += [(500 + i, " ".join(base[: 90 + 2 * i])) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates.near_duplicates(df).collect()}
    assert got == brute.near_duplicates(rows, 85)


def test_contamination(spark, odd, odd_rows, documents, rows):
    benchmark = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    extra = [(900, "one"), (901, "WORD1 and"), (902, None), (903, ""), (None, "and"), (904, " ".join(f"word{i} and {i}" for i in range(30))), (905, "one")]
    items = spark.createDataFrame(benchmark + extra, "item_id long, text string").withColumn("doc_id", F.lit(1))
    known = [(i, t) for i, t in benchmark + extra if i is not None]
    for df, own in ((odd, odd_rows), (documents, rows)):
        got = decontaminate.op3_columns(decontaminate.contamination(df, items)).collect()
        assert [tuple(r) for r in got] == brute.contamination(own, known)
    parts = decontaminate.op3_columns(decontaminate.contamination(documents, items, pass_bytes=2000)).collect()
    assert sorted(map(tuple, parts)) == sorted(brute.contamination(rows, known))
    assert decontaminate.op3_columns(decontaminate.contamination(documents, items.limit(0))).where("n_hit > 0 OR n_items > 0").count() == 0
    assert decontaminate.contamination(documents.limit(0), items).count() == 0


def test_contamination_in_several_passes(spark, odd, odd_rows):
    """Rows without a key or with one key keep their own result also when the benchmark takes several passes."""
    benchmark = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    known = benchmark + [(900, "one"), (904, " ".join(f"word{i} and {i}" for i in range(30))), (905, "one"), (906, "漢字 none")]
    items = spark.createDataFrame([*known, (None, "and"), (902, None)], "item_id long, text string")
    more = [(None, "clean words"), (None, known[0][1]), (7, known[1][1]), (7, known[1][1] + " " + known[2][1])]
    own = odd_rows + more
    df = odd.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    n, groups = decontaminate._passes(items, "item_id", "text", 1000)
    groups = list(groups)
    assert n == len(groups) > 2 and sorted(i for g in groups for i in g) == sorted((str(k), t.encode()) for k, t in known)
    for name in ("doc_id", "number"):
        found = decontaminate.contamination(df.withColumnRenamed("doc_id", name), items, name, pass_bytes=1000)
        got = decontaminate.op3_columns(found, name).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(brute.contamination(own, known), key=repr)


def test_repeats(odd, odd_rows, documents, rows):
    want = brute.repeats(rows)
    got = repeats.remove_repeats(documents).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == {
        k: (*w[:3], hashlib.sha256(w[3]).hexdigest()) for k, w in want.items()
    }
    distinct = [(k, t) for k, t in dict(odd_rows).items() if k]
    want = brute.repeats(distinct)
    got = repeats.remove_repeats(odd).collect()
    assert len(got) == len(odd_rows)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in got if r.doc_id} == {k: w[:3] for k, w in want.items()}
    assert [r.n_removed for r in got if r.doc_id is None] == [0]
    whole = repeats.remove_repeats(odd, texts=True)
    assert whole.columns == odd.columns
    for r in whole.collect():
        if r.doc_id:
            text = dict(odd_rows)[r.doc_id]
            assert r.text == (None if text is None else brute.cut_text(text, want[r.doc_id][4]))
            assert r.doc == [1] and r.score == 2.5
    assert repeats.remove_repeats(odd.limit(0)).count() == 0


def test_repeats_of_shared_passages(spark):
    """A passage in many texts between other words, lines that repeat in one text, and strings just too short."""
    passage = " ".join(f"shared{i}" for i in range(60))
    rows = [(i, f"begin{i} " * 9 + passage + f" end{i}" * 9) for i in range(40)]
    rows += [(100, "x" * 49), (101, "x" * 49), (102, "y" * 120), (103, "z" + "y" * 60), (104, "line again\n" * 50), (50, passage[7:56]), (51, passage[7:57])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(df).collect()}
    assert got == {k: (*w[:3], hashlib.sha256(w[3]).hexdigest()) for k, w in brute.repeats(rows).items()}


def test_language(odd, documents):
    model = language.train(documents.where(F.col("doc_id") % 3 != 1))
    got = language.identify(documents.where(F.col("doc_id") % 3 == 1), model)
    assert got.where("lang = lang_pred").count() >= 0.97 * got.count()
    assert got.where("NOT score BETWEEN 0 AND 1").count() == 0
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(odd, model).collect()}
    for key in (1, 2, 3, 13):
        assert found[key] == ("und", 0.0)
    assert found[4][0] != "und"
    empty = language.train(documents.limit(0))
    assert {r.lang_pred for r in language.identify(odd, empty).collect()} == {"und"}
    assert language.identify(odd.limit(0), model).count() == 0


def plain_ngrams(text):
    """Hashed n-grams of one to three characters, a number at a time."""
    points = [ord(c.lower()) if c.isalpha() and len(c.lower()) == 1 else ord(c) if c.isalpha() else 32 for c in text]
    low = 0xFFFFFFFF
    for size in (1, 2, 3):
        for at in range(len(points) - size + 1):
            x = size
            for point in points[at : at + size]:
                x = (x ^ point) * 0x9E3779B1 & low
                x ^= x >> 15
            yield (x * 0x85EBCA6B & low) >> 16


def test_language_against_plain_naive_bayes(documents, odd):
    rows = documents.select("doc_id", "text", "lang").collect()
    texts = {(r.lang, r.text) for r in rows if r.doc_id % 3 != 1 and r.lang is not None and r.text is not None}
    counts = {}
    for lang, text in texts:
        counts.setdefault(lang, Counter()).update(plain_ngrams(text))
    names = sorted(counts)
    total = {lang: sum(counts[lang].values()) + 0.5 * 2**16 for lang in names}

    def plain(text):
        if not any(c.isalpha() for c in text or ""):
            return "und", 0.0
        found = Counter(plain_ngrams(text))
        logs = [sum(n * math.log((counts[lang][f] + 0.5) / total[lang]) for f, n in found.items()) for lang in names]
        best = max(range(len(names)), key=lambda k: logs[k])
        return names[best], 1 / sum(math.exp(x - logs[best]) for x in logs)

    model = language.train(documents.where(F.col("doc_id") % 3 != 1))
    both = documents.select("doc_id", "text").unionByName(odd.select(F.col("doc_id").cast(documents.schema["doc_id"].dataType), "text"))
    got = language.identify(both, model).collect()
    assert len(got) == both.count() > 200
    for r in got:
        lang, score = plain(r.text)
        assert r.lang_pred == lang and r.score == pytest.approx(score, abs=1e-3)


def test_language_of_long_texts_in_pieces(documents, monkeypatch):
    import pyarrow as pa

    model = language.train(documents)
    texts = [r.text for r in documents.select("text").limit(40).collect()]
    whole = model.predict(pa.array(texts))
    monkeypatch.setattr(language, "PIECE", 500)
    pieces = model.predict(pa.array(texts))
    assert whole[0] == pieces[0]


def test_folding():
    import pyarrow as pa

    texts = ["Y0u M0R0N!", "1d10t", "ѕсum", "100 $$$ word$$$", "ＩＤＩＯＴ", None, ""]
    assert [t.split() for _, t in toxicity._texts(pa.array(texts))] == [["you", "moron"], ["idiot"], ["scum"], ["word"], ["idiot"], [], []]


def test_exceptions_and_hits():
    lexicon = toxicity.Lexicon({" trash ": 3.0, " lowei": 2.0, " idiot ": 3.0})
    automaton = lexicon.automaton()
    assert toxicity.hits(automaton, " the trash can ") == []
    assert toxicity.hits(automaton, " trash trash bin loweiss idiot idiots ") == [3.0, 2.0, 3.0]


def test_toxicity(spark, odd):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    lexicon = toxicity.train(toxicity.labelled(docs, labels))
    scored = toxicity.toxicity(docs, lexicon).join(labels, "doc_id").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    own = scored.select("toxic", "score").toPandas()
    ranks = own.score.rank()
    n1, n0 = (own.toxic == 1).sum(), (own.toxic == 0).sum()
    assert (ranks[own.toxic == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0) > 0.8
    found = toxicity.toxicity(odd, lexicon).collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    assert len({r.score for r in found if not r.text}) == 1
    bare = toxicity.train(toxicity.labelled(docs.limit(0), labels))
    texts = spark.createDataFrame(pd.DataFrame({"text": ["you idiot", "you 1d10t", "hello"]}))
    assert [r.predicted for r in toxicity.toxicity(texts, bare).collect()] == [1, 1, 0]
    assert toxicity.toxicity(odd.limit(0), bare).count() == 0


@pytest.mark.parametrize("percent", [79, 101])
def test_thresholds_out_of_range(documents, percent):
    with pytest.raises(ValueError):
        near_duplicates.near_duplicates(documents, percent)


def test_language_training_counts_copies_once(spark):
    """Copies neither fill the sample nor shrink the share of the other texts."""
    import numpy as np

    texts = [(f"some words of number {i} and {i * 7}", "en") for i in range(400)] + [(f"einige worte {i}", "de") for i in range(5)]
    once = spark.createDataFrame(texts, "text string, lang string")
    often = once.union(spark.createDataFrame([texts[0]] * 5000 + [texts[1]] * 5000 + [texts[-1]] * 50, once.schema))
    for train_rows in (100, 20_000):
        a, b = (language.train(df, train_rows=train_rows) for df in (once, often))
        assert a.languages == b.languages and np.array_equal(a.weights, b.weights)


def test_repeats_around_one_line(spark):
    """A line shorter than the strings in all documents, whole passages in some; the strings around the line are dealt out one by one."""
    line = "All rights reserved by the office."
    rows = [(i, f"start {i * 7919 % 1000} {line} {'shared ending of some length ' * 2 if i % 5 == 0 else ''}{i * 31 % 70}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute.repeats(rows)
    gone = {}
    for r in repeats.repeated_spans(df, heavy=10).collect():
        gone.setdefault(r.doc, set()).update(range(r.start, r.start + r.n + 49))
    assert {k: len(v) for k, v in gone.items()} == {k: w[1] for k, w in want.items() if w[1]}


def test_no_bucket_holds_all_around_a_line(spark):
    """Of documents with one line the strings around it are spread over the buckets; passes give the same spans."""
    line = "All rights reserved by the office."
    rows = [(i, f"{i * 7919:x} before {i * 104729:x} {line} after {i % 500} and all else") for i in range(3000)]
    asked = repeats._packed(spark.createDataFrame(rows, "doc long, text string").repartition(4))
    data, offsets = ragged.flat(pa.array([rows[0][1]]))
    codes = repeats.Parse(data, offsets, 50, phrases=False).codes()
    address = repeats._address((codes % np.uint64(16)).astype(np.int64), codes).astype(np.int64)
    asked = asked.withColumn("asks", F.array(*[F.lit(int(a)) for a in set(address.tolist())]))
    spans = {}
    for heavy in (address[:0], np.sort(address)):
        packed = repeats._suffixes(asked, 16, 16, 50, spark.sparkContext.broadcast(heavy)).toArrow()
        buckets = [packed.filter(pa.compute.equal(packed["bucket"], b)) for b in range(16)]
        sizes = sorted((sum(len(x) for x in b["data"].to_pylist()) for b in buckets), reverse=True)
        assert sizes[0] < 2 * sum(sizes) / 16 if len(heavy) else sizes[0] > 0.5 * sum(sizes)
        for at_once in (repeats.PASS, 999):
            gone = [repeats._ordered(b, 50, at_once).to_pylist() for b in buckets if b.num_rows]
            spans[len(heavy), at_once] = {(r["doc"], r["start"] + k) for g in gone for r in g for k in range(r["n"])}
    assert len(set(map(frozenset, spans.values()))) == 1 and len(spans[0, 999]) > 100


def plain_score(text, lexicon):
    """A naive scan of the lexicon's patterns and exceptions, a character and a pattern at a time."""
    import math

    def fold(endings):
        out = []
        for i, c in enumerate(text):
            low = c.lower() if len(c.lower()) == 1 else c
            if c.isalpha():
                out.append(chr(ord(c) - 0xFEE0 + (32 if "Ａ" <= c <= "Ｚ" else 0)) if "Ａ" <= c <= "Ｚ" or "ａ" <= c <= "ｚ" else toxicity.HOMOGLYPHS.get(low, low))
            elif c in toxicity.SUBSTITUTES:
                after, before = text[i:].lstrip("".join(toxicity.SUBSTITUTES)), text[:i].rstrip("".join(toxicity.SUBSTITUTES))
                inside = after[:1].isalpha() or (endings and before[-1:].isalpha())
                out.append(toxicity.SUBSTITUTES[c] if inside else " ")
            else:
                out.append(" ")
        return " " + "".join(out) + " "

    best, spared = {}, []
    for whole in (fold(False), fold(True)):
        for pattern, weight in [*lexicon.weights.items(), *((f" {e} ", None) for e in lexicon.exceptions)]:
            at = whole.find(pattern)
            while at >= 0:
                if weight is None:
                    spared.append((at, at + len(pattern) - 1))
                else:
                    best[at] = max(best.get(at, 0), weight)
                at = whole.find(pattern, at + 1)
    found = [w for b, w in best.items() if not any(x <= b < y for x, y in spared)]
    total, n = sum(found), len(fold(False).split())
    x = (max(found, default=0.0), math.log1p(total), math.log1p(100 * total / max(n, 1)))
    constant, *slopes = lexicon.fit
    return 1 / (1 + math.exp(-(constant + sum(a * b for a, b in zip(slopes, x)))))


def test_toxicity_against_naive_scan(spark, documents, sf):
    lexicon = toxicity.train(toxicity.labelled(documents, spark.read.parquet(f"{sf}/labels.parquet")))
    texts = [r.text for r in documents.orderBy("doc_id").limit(60).collect()] + [
        "You dumba$$!", "a$$hole", "an 1d10t", "idiot1", "idiot", "IDIOT 5", "mоrоn", "jerk chicken and jerk", "trash bag", "ＩＤＩＯＴ", "a55", "", "$ 4 7", "l0$er5 l0$er",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.toxicity(df, lexicon).collect()}
    for i, t in enumerate(texts):
        assert got[i] == pytest.approx(plain_score(t, lexicon), abs=1e-9), t
    scores = dict(zip(texts, got.values()))
    assert scores["You dumba$$!"] > scores["a55"] and scores["idiot1"] == scores["idiot"]


def test_repeated_labels_count_once(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id long, text string")
    labels = spark.createDataFrame([(i % 50, None, i % 2) for i in range(2000)] + [(None, 1, 1), (3, 0, None)], "doc_id long, quality int, toxic int")
    got = toxicity.labelled(docs, labels).collect()
    assert len(got) == len(set(got)) == sum(1 for i in range(50) if __import__("zlib").crc32(str(i).encode()) % 5)


def test_index_of_a_large_benchmark():
    """A million windows: skips stay long, and a worker builds an index once."""
    rng = np.random.default_rng(4)
    items = [(str(i), " ".join(map(str, rng.integers(0, 200_000, 100))).encode()) for i in range(12_000)]
    kept = decontaminate.Kept()
    index = kept.of("a", items, 13)
    assert kept.of("a", [], 13) is index and kept.of("b", items[:5], 13) is not index
    assert len(index[0].place) == 12_000 * 88 and index[0].shift.mean() > 10
    texts = [b"x " * 50 + items[7][1][40:240] + b" y", items[5][1].upper(), b"none of it " * 100]
    data, offsets = ragged.flat(pa.array(texts, pa.large_binary()))
    _, runs, found = decontaminate.search(data, offsets, index, [k for k, _ in items])
    assert found == [{"7"}, {"5"}, set()] and runs[1] == [(0, 100)] and not runs[2]
