"""Models and packing against plain computations, and operators on repeated and clashing rows."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.llm import ann, embed_dedup, langid, packing, quality, url_lists, warc

MORE = "/root/testdata/sf0.01"


def clashing(frame, *names):
    for i, name in enumerate(names):
        frame = frame.withColumn(name, F.lit(i))
    return frame


def test_quality_equals_plain_discriminant(spark):
    """Scores from densities with solved systems and determinants, no factors kept."""
    docs = spark.read.parquet(f"{MORE}/documents.parquet")
    labels = spark.read.parquet(f"{MORE}/labels.parquet")
    of = quality.Statistics()
    x = {r.doc_id: np.array(of((r.text or "").encode())) for r in docs.collect()}
    train = {r.doc_id: r.quality for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5}
    parts = [np.array([x[d] for d, q in train.items() if q == k and d in x]) for k in (0, 1)]
    every = np.concatenate(parts)
    scale = np.sqrt(np.maximum(every.var(axis=0), 1e-4))
    spread = [np.cov(p.T, bias=True) / np.outer(scale, scale) for p in parts]
    pooled = sum(len(p) * s for p, s in zip(parts, spread, strict=True)) / len(every)
    ridge = np.diag(np.diag(pooled)) + 0.01 * np.eye(len(scale))

    def density(values, k):
        cov = 0.95 * (0.9 * spread[k] + 0.1 * pooled) + 0.05 * ridge
        z = (values - parts[k].mean(axis=0)) / scale
        return np.log(len(parts[k]) / len(every)) - 0.5 * (np.linalg.slogdet(cov)[1] + z @ np.linalg.solve(cov, z))

    got = {r.doc_id: r for r in quality.score_quality(docs, labels).collect()}
    assert set(got) == set(x)
    for d, values in x.items():
        want = 1 / (1 + np.exp((density(values, 0) - density(values, 1)) / quality.TEMPERATURE))
        assert got[d].score == pytest.approx(want, abs=1e-6) and got[d].predicted == (got[d].score >= 0.3)
    # Repeated rows change nothing but how often a row comes.
    twice = quality.score_quality(clashing(docs.union(docs), "x", "label", "score"), labels.union(labels)).collect()
    assert len(twice) == 2 * len(x)
    kept = quality.keep_good(docs, labels)
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {d for d, r in got.items() if r.predicted}


def test_language_equals_plain_compression(spark):
    import zstandard

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    dictionaries = langid.train(docs)
    got = {r.doc_id: r for r in langid.identify_language(docs).collect()}
    how = zstandard.ZstdCompressionParameters(
        compression_level=6, min_match=3, strategy=zstandard.STRATEGY_BTOPT, write_content_size=False, write_dict_id=False
    )
    ways = {}
    for lang, content in dictionaries.items():
        own = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        # A prepared dictionary is compressed with these settings, one that is not with others.
        own.precompute_compress(compression_params=how)
        ways[lang] = zstandard.ZstdCompressor(compression_params=how, dict_data=own)
    for row in docs.collect():
        text = langid.letters(row.text or "").encode()
        sizes = {}
        for lang, way in ways.items():
            sizes[lang] = sum(len(way.compress(b" " * 64 + text[i : i + 1024])) for i in range(0, len(text), 1024))
        best, second = sorted(sizes, key=lambda k: (sizes[k], k))[:2]
        margin = (sizes[second] - sizes[best]) / sizes[second]
        assert (got[row.doc_id].lang_pred, got[row.doc_id].score) == (best, pytest.approx(margin))
        assert got[row.doc_id].rejected == (margin < langid.NARROW)


def test_language_ties_and_long_texts(spark):
    rows = [(i, "alpha beta gamma delta " * 40, lang, "a") for i, lang in enumerate(["x", "y"] * 8)]
    rows += [(100, "alpha beta " * 60_000, None, "a"), (101, "1234 5678", None, "a"), (102, None, None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string").withColumn("rank", F.lit(0))
    got = {r.doc_id: r for r in langid.identify_language(docs).collect()}
    # Both languages have the same dictionary: the first by name, with no margin.
    assert all((got[i].lang_pred, got[i].score, got[i].rejected) == ("x", 0.0, True) for i in (*range(16), 100))
    assert got[101].lang_pred == got[102].lang_pred == "und"


def test_packing_of_a_given_table(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(packing.tokenizer_path())
    docs = clashing(spark.read.parquet(f"{MORE}/documents.parquet"), "ids", "length", "offset")
    rows = packing.pack_documents(docs, with_ids=True).collect()
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.ids, r.ids_crc32, r.doc_tokens))
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    assert set(pieces) == set(texts)
    for doc, text in texts.items():
        ids = [*whole.encode(text, add_special_tokens=False).ids, 1]
        at = 0
        for start, length, own, crc, total in sorted(pieces[doc]):
            assert (start, total, list(own)) == (at, len(ids), ids[at : at + length])
            assert crc == zlib.crc32(np.array(own, "<u4").tobytes())
            at += length
        assert at == len(ids)
    fills = {}
    for r in rows:
        fills[r.sequence_id] = fills.get(r.sequence_id, 0) + r.length
    assert sum(fills.values()) >= 0.95 * packing.WINDOW * len(fills)


def test_vectors_of_repeated_ids(spark):
    """Rows that repeat an id are one vector, the least; links are other ids."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 8))
    x[30:] = x[:30] + rng.normal(size=(30, 8)) * 0.05
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    again = [(i, [v + 5 for v in r]) for i, r in rows[::4]]  # greater, so it does not count
    frame = spark.createDataFrame(rows * 3 + again, "vec_id long, embedding array<double>")
    frame = clashing(frame, "links", "other", "component", "vec", "place", "node", "copy")
    single = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    one = {r.vec_id: tuple(r) for r in embed_dedup.near_duplicates(single).collect()}
    many = [tuple(r) for r in embed_dedup.near_duplicates(frame).collect()]
    assert set(many) == set(one.values()) and len(many) == 3 * 60 + len(again)
    assert all(one[i][1] >= 1 for i in range(60))
    near = [sorted(tuple(r) for r in ann.nearest(f, every=7).collect()) for f in (single, frame)]
    assert near[0] == near[1]


def test_pages_repeated_and_long(spark):
    long = "<p>" + "word " * 400_000
    rows = [(1, "http://a", long), (1, "http://a", long), (2, "http://b", long), (3, None, "x"), (3, None, "x"), (4, "u" * 9000, None)]
    pages = clashing(spark.createDataFrame(rows, "page_id long, url string, html string"), "record", "original", "payload_digest", "refers_to")
    got = sorted(tuple(r) for r in warc.archived_pages(pages).collect())
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == [
        (1, len(long), digest(long), "response", None), (1, len(long), digest(long), "response", None),
        (2, len(long), digest(long), "revisit", 1), (3, 1, digest("x"), "response", None), (3, 1, digest("x"), "response", None),
        (4, 0, digest(""), "response", None),
    ]


def test_url_list_ties(spark):
    """Equally long patterns: the greater text; a day's last entry counts."""
    entries = [("l", "b.com", "2024-01-01", 1, False), ("l", "b.com", "2024-01-01", 2, True), ("m", "b.com", "2024-01-01", None, True),
               ("l", "a.b.com", "2024-01-01", 0, True), ("l", "b.com/x", "2024-01-01", 0, True), ("l", "b.com/x", "2024-01-01", 0, True)]
    entries = spark.createDataFrame(entries, "list string, pattern string, day string, seq int, listed boolean")
    entries = entries.withColumn("day", F.col("day").cast("date"))
    rows = [(1, "http://a.b.com/x", "2024-02-01"), (2, "http://b.com/x", "2024-02-01"), (2, "http://b.com/x", "2024-02-01")]
    captures = spark.createDataFrame(rows, "capture_id long, url string, fetched string")
    captures = clashing(captures.withColumn("fetched", F.col("fetched").cast("date")), "list", "n_active", "valid_from")
    got = {r.capture_id: (r.n_active, r.matched) for r in url_lists.evaluate_captures(captures, entries).collect()}
    assert got == {1: (3, "a.b.com"), 2: (3, "b.com/x")}
