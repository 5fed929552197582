"""The training-data operators against brute force and on odd tables."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.llm import ann, chat, embed_dedup, langid, mixing, ngram_join, packing, quality, url_lists, warc
from feedloom.llm.queries import LLM_QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, label string"
BASE = " ".join(f"w{i}" for i in range(60))
ODD = [
    (1, BASE, "en", "a", 0, "x"),
    (2, BASE + " end", "en", "a", 0, "x"),
    (3, None, None, None, None, None),
    (4, "", "en", "b", 0, "x"),
    (5, " \t\n", "en", "b", 0, "x"),
    (6, "A b", "en", "b", 0, "x"),
    (7, "a B", "fr", None, 0, "x"),
    (8, BASE, "en", "a", 0, "x"),
    (8, BASE, "en", "a", 0, "x"),
    (None, BASE, "en", "a", 0, "x"),
    (9, "long " * 30_000, "en", "a", 0, "x"),
    (10, "x" * 50_000, "en", "c", 0, "x"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def shingle_set(text):
    table = {c: c + 32 for c in range(65, 91)}
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(table))
    return {tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def test_join_odd_rows(odd, empty):
    rows = ngram_join.jaccard_components(odd).collect()
    assert len(rows) == len(ODD)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert got[None] == (58, None)
    assert {k: v for k, v in got.items() if k is not None} == {
        1: (58, 1), 2: (59, 1), 3: (0, 3), 4: (0, 4), 5: (0, 5), 6: (1, 6), 7: (1, 6), 8: (58, 1), 9: (1, 9), 10: (1, 10)
    }
    assert ngram_join.jaccard_components(empty).collect() == []


@pytest.mark.parametrize("times", [1, 2, 3])
def test_join_of_repeated_rows(spark, times):
    """A table with every row several times has the groups of the table itself."""
    rng = np.random.default_rng(11)
    texts = {}
    for pair in range(40):
        words = [f"p{pair}w{i}" for i in range(240)]
        for copy in range(3):
            new = list(words)
            for at in rng.choice(240, 2 * copy, replace=False):
                new[at] = f"e{copy}x{at}"
            texts[3 * pair + copy] = " ".join(new)
    sets = {d: shingle_set(t) for d, t in texts.items()}
    label = {d: d for d in texts}
    for _ in range(3):
        for a in texts:
            for b in range(a // 3 * 3, a // 3 * 3 + 3):
                both = len(sets[a] & sets[b])
                if 100 * both >= 90 * (len(sets[a]) + len(sets[b]) - both):
                    label[a] = label[b] = min(label[a], label[b])
    rows = [(d, t) for d, t in texts.items()] * times
    rng.shuffle(rows)
    frame = spark.createDataFrame([(int(d), t) for d, t in rows], "doc_id long, text string").repartition(3)
    got = [(r.doc_id, r.component_id) for r in ngram_join.jaccard_components(frame).collect()]
    assert sorted(got) == sorted(list(label.items()) * times)


def test_copies_with_edits_meet_in_few_runs(spark, monkeypatch):
    """A pair comes out of a few runs, not of one for each shingle its texts share."""
    rng = np.random.default_rng(3)
    texts = {}
    for copy in range(60):
        words = [f"w{i}" for i in range(300)]
        for at in rng.choice(300, 3 + copy % 7, replace=False):
            words[at] = f"e{copy}x{at}"
        texts[copy] = " ".join(words)
    sets = {}
    for d, t in texts.items():
        words = t.split()
        sets[d] = {tuple(words[i : i + 5]) for i in range(296)}
    label = {d: d for d in texts}
    for _ in range(4):
        for a in texts:
            for b in texts:
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    label[a] = label[b] = min(label[a], label[b])
    made, pairs = spark.sparkContext.accumulator(0), ngram_join._tree_pairs

    def counted(percent):
        run = pairs(percent)

        def count(batches):
            for batch in run(batches):
                made.add(batch.num_rows)
                yield batch

        return count

    monkeypatch.setattr(ngram_join, "_tree_pairs", counted)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(frame, 5, 80).collect()}
    assert got == label and len(set(label.values())) > 1
    assert made.value <= 60 * 59 // 2


def test_tree_loses_no_pair():
    rng = np.random.default_rng(5)
    sets = []
    for _ in range(40):
        base = rng.integers(0, 1 << 60, rng.integers(5, 3000)).astype(np.uint64)
        for _ in range(rng.integers(1, 5)):
            keep = base[rng.random(len(base)) > rng.choice([0, 0.02, 0.06])]
            sets.append(np.unique(keep))
    n = np.array([len(s) for s in sets])
    signs = [ngram_join.bitmap(s) for s in sets]
    width = min(map(len, signs)) // 8
    words = np.concatenate([ngram_join.folded(np.frombuffer(b, np.uint64)[None], width) for b in signs])
    tree = ngram_join.SignatureTree(n, words, np.arange(len(sets)))
    i, j = ngram_join.traverse(tree, tree, 90)
    found = {(min(a, b), max(a, b)) for a, b in zip(i.tolist(), j.tolist(), strict=True)}
    assert len(found) == len(i)
    for a in range(len(sets)):
        for b in range(a + 1, len(sets)):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 90 * (len(sets[a]) + len(sets[b]) - both):
                assert (a, b) in found


def test_mixing(spark, odd, empty):
    rows = mixing.mix_documents(odd).collect()
    assert {r.doc_id: r.size for r in rows}[3] == 0
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    assert mixing.mix_documents(empty).collect() == []
    rows = LLM_QUERIES["op2_mixing"](spark, SF)
    rows = rows.groupBy("source_size", "target").agg(F.sum("taken").alias("taken")).collect()
    assert all(abs(r.taken - r.target) <= 1 for r in rows)


def test_embeddings(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 24))
    x[200:] = x[:100] + rng.normal(size=(100, 24)) * 0.12
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(900, None), (901, [0.0] * 24), (902, [float("nan")] * 24), (903, [1.0, 2.0]), (904, []), (None, [1.0] * 24)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("label", F.lit(1))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    label = np.arange(300)
    for _ in range(300):
        label = np.minimum(label, np.where(near, label[None, :], 300).min(axis=1))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embed_dedup.near_duplicates(frame).collect()}
    for i in range(300):
        assert got[i] == (near[i].sum(), label[i], label[i] == i)
    assert got[900] == (0, 900, True) and got[903] == (0, 903, True) and got[None] == (0, None, False)
    assert embed_dedup.near_duplicates(frame.where("vec_id < 0")).collect() == []

    found = ann.nearest(frame).where("query_id < 300").collect()
    product = x @ x.T
    np.fill_diagonal(product, -np.inf)
    best = {(q, int(v)) for q in range(0, 300, 20) for v in np.argsort(-product[q])[:20]}
    assert len(found) == 15 * 20
    assert len(best & {(r.query_id, r.vec_id) for r in found}) >= 0.95 * len(best)
    assert all(abs(r.score - product[r.query_id, r.vec_id]) < 1e-12 for r in found)
    assert ann.nearest(frame.where("vec_id < 0")).collect() == []


def test_graph_recall():
    x = np.random.default_rng(4).normal(size=(3000, 32))
    q = x[::30]
    found, _ = ann.search_graph(x, ann.build_graph(x), q, 20, ann.BEAM)
    true = np.argsort(-(q @ x.T), axis=1)[:, :20]
    assert np.mean([np.isin(t, f).mean() for t, f in zip(true, found, strict=True)]) >= 0.9


def test_warc_odd_rows(spark):
    big = "y" * 150
    rows = [
        (1, "http://a/\r\nWARC-Type: x", big, 0), (2, None, big, 0), (3, "http://c", None, 0), (4, "u", "", 0),
        (5, "u", "s\r\n\r\nWARC/1.1\r\n", 0), (6, "u", "s\r\n\r\nWARC/1.1\r\n", 0), (7, "u", "é" * 60, 0), (8, "u%0A", "é" * 60, 0),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record_type int")
    got = {r.page_id: r for r in warc.archived_pages(pages).collect()}
    assert {k: r.refers_to for k, r in got.items()} == {1: None, 2: 1, 3: None, 4: None, 5: None, 6: None, 7: None, 8: 7}
    for page_id, _, html, _ in rows:
        data = (html or "").encode()
        assert (got[page_id].payload_bytes, got[page_id].payload_digest) == (len(data), hashlib.sha256(data).hexdigest())
    assert warc.archived_pages(pages.where("page_id < 0")).collect() == []


def test_url_lists(spark):
    entries = spark.createDataFrame(
        [("l", "b.com", "2024-01-10", 0, True), ("l", "b.com", "2024-03-01", 1, False), ("l", "b.com", "2024-03-01", 0, True),
         ("p", "a.b.com/x", "2024-02-01", 0, True), ("l", None, "2024-01-01", 0, True)],
        "list string, pattern string, day string, seq int, listed boolean",
    ).withColumn("day", F.col("day").cast("date"))
    rows = [(1, "https://u@A.b.com:80/x/y?q", "2024-02-15"), (2, "http://a.b.com/x", "2024-03-01"), (3, "http://b.com", "2024-01-09"),
            (4, None, "2024-02-01"), (5, "nonsense", "2024-02-01"), (6, "http://b.com", None), (7, "http://xb.com/", "2024-02-01")]
    captures = spark.createDataFrame(rows, "capture_id long, url string, fetched string")
    captures = captures.withColumn("fetched", F.col("fetched").cast("date"))
    got = {r.capture_id: (r.n_active, r.matched) for r in url_lists.evaluate_captures(captures, entries).collect()}
    assert got == {1: (2, "a.b.com/x"), 2: (1, "a.b.com/x"), **{k: (0, None) for k in (3, 4, 5, 6, 7)}}


def test_url_lists_of_any_depth_and_day(spark):
    entries = [("l", "b.com", "1999-01-10", 0, True), ("p", "a.b.com/x/y/z/w", "2024-02-01", 0, True), ("p", "a.b.com/x/y/z/w", "2024-02-01", 0, True)]
    entries = spark.createDataFrame(entries, "list string, pattern string, day string, seq int, listed boolean")
    entries = entries.withColumn("day", F.col("day").cast("date"))
    rows = [(1, "http://a.b.com/x/y/z/w/v", "2031-05-05"), (1, "http://a.b.com/x/y/z/w/v", "2031-05-05"), (2, "http://a.b.com/x/y", "1999-01-10"),
            (3, "http://a.b.com/x/y/z/w", "2024-01-31"), (4, "http://b.com/" + "s/" * 20_000, "2024-01-31")]
    captures = spark.createDataFrame(rows, "capture_id long, url string, fetched string")
    captures = captures.withColumn("fetched", F.col("fetched").cast("date")).withColumn("month", F.lit(0)).withColumn("pattern", F.lit("q"))
    got = {r.capture_id: (r.n_active, r.matched) for r in url_lists.evaluate_captures(captures, entries).collect()}
    assert got == {1: (2, "a.b.com/x/y/z/w"), 2: (1, "b.com"), 3: (1, "b.com"), 4: (1, "b.com")}
    for a, b in ((captures.where("capture_id < 0"), entries), (captures, entries.where("seq > 0"))):
        assert all(r.n_active == 0 for r in url_lists.evaluate_captures(a, b).collect())


def test_quality(spark, odd, empty):
    more = SF.replace("0.001", "0.01")  # the smallest tables have 19 held-out labels
    docs = spark.read.parquet(f"{more}/documents.parquet")
    labels = spark.read.parquet(f"{more}/labels.parquet")
    rows = quality.score_quality(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert np.mean([r.predicted == r.quality for r in held]) >= 0.9
    none = labels.where("doc_id < 0")
    assert {r.score for r in quality.score_quality(odd, none).collect()} == {0.5}
    assert quality.score_quality(empty, labels).collect() == []


def test_language(spark, odd, empty):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = langid.identify_language(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows if r.held_out]) >= 0.95
    got = {r.doc_id: r for r in langid.identify_language(odd).collect()}
    assert got[3].lang_pred == got[4].lang_pred == got[5].lang_pred == "und" and got[3].rejected
    assert langid.identify_language(empty).collect() == []


def test_packing(odd, empty):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(packing.tokenizer_path())
    rows = packing.pack_documents(odd, with_ids=True).collect()
    texts = [(t or "", d) for d, t, *_ in ODD if d != 8]
    for text, doc in texts:
        pieces = sorted((r for r in rows if r.doc_id == doc), key=lambda r: r.start)
        ids = [*whole.encode(text, add_special_tokens=False).ids, 1]
        assert [i for r in pieces for i in r.ids] == ids
        assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.doc_tokens == len(ids) for r in pieces)
    for sequence in {r.sequence_id for r in rows}:
        own = sorted((r for r in rows if r.sequence_id == sequence), key=lambda r: r.offset)
        ends = np.cumsum([0] + [r.length for r in own])
        assert [r.offset for r in own] == ends[:-1].tolist() and ends[-1] <= packing.WINDOW
    assert packing.pack_documents(empty).collect() == []


@pytest.mark.parametrize("text", ["It's 3.5, 'S. don't... ÉCOLE, x.", "<|endoftext|> <|ENDOFTEXT|> a", "İi ﬁ e\u0301 ΣΑΣ. 漢字, \u00a0b", "a.b. c,d,\ne", "abc*** É!! it's!! 12! x́!! ab-- '' don't'' İ!! a1?? !!! b½!"])
def test_word_tokens(text):
    tokens = packing.WordTokens(packing.tokenizer_path())
    assert list(tokens.encode([text]))[0] == tokens.whole(text)


def test_marked_words_are_learnt_together(monkeypatch):
    """A plain word with marks behind is not encoded alone, only its marks are, once."""
    tokens = packing.WordTokens(packing.tokenizer_path())
    text, alone, whole = "zqone*** zqtwo*** zqthré*** zqone", [], tokens.whole
    want = whole(text)
    monkeypatch.setattr(tokens, "whole", lambda word: alone.append(word) or whole(word))
    monkeypatch.setattr(tokens, "known", packing.Known())
    assert list(tokens.encode([text, text])) == [want, want]
    assert alone == ["***"]


def test_level_array():
    packer = packing.Packer(8, 0)
    list(packer.add("a", b"\0" * 12))
    list(packer.add("b", b"\0" * 12))  # beside the first the sum is 1 at level 6; apart it is 4
    assert packer.count.tolist() == [0, 0, 0, 0, 0, 0, 1, 0, 0]


def test_templates():
    def render(source, **env):
        return "".join(t for t, _ in chat.compile_template(source)(env))

    assert render("{{ 'a' + 'b' | upper }}{# no #}{% if 1 == 2 %}x{% elif n > 1 %}y{% else %}z{% endif %}", n=2) == "aBy"
    assert chat.fold(chat.parse("a{{ 'b' }}{% if not 0 %}c{% endif %}")) == [("text", "abc")]
    assert render("{% for t in ts %}{{ loop.index }}{{ t.x }}{% endfor %}", ts=[{"x": "p"}, {"x": "q"}]) == "1p2q"
    for bad in ("{{ a.__class__ }}", "{{ a | exec }}", "{% for %}", "{% if a %}", "{{ a( }}", "{% endif %}"):
        with pytest.raises(chat.TemplateError):
            chat.compile_template(bad)


def test_chat_odd_rows(spark):
    rows = [(1, 0, None, None), (1, 1, "assistant", "#" * 5 + " \\n</turn>\n"), (1, None, "a:\nb#", "x"), (None, 0, "user", "q"),
            (1, 1, "assistant", "#" * 5 + " \\n</turn>\n"), (2, 0, "assistant", "z" * 200_000), (2, 1, "user", "### u:\n")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(frame)).collect()}
    said = "".join(f"{r}\n{t}\n" for r, t in [("a:\nb#", "x"), ("", ""), *[("assistant", rows[1][3])] * 2])
    assert (got[1].n_turns, got[1].turns_sha256) == (4, hashlib.sha256(said.encode()).hexdigest())
    assert (got[1].loss_chars, got[1].loss_sha256) == (2 * len(rows[1][3]), hashlib.sha256((rows[1][3] * 2).encode()).hexdigest())
    assert got[2].n_turns == 2 and got[None].n_turns == 1
    assert chat.read_back(chat.format_conversations(frame.where("turn > 9"))).collect() == []


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:3]:
        before, docs = docs, stage(spark, docs, SF)
        assert docs.columns == columns and docs.count() <= before.count(), name
    texts = [r.text for r in docs.collect()]
    sets = [shingle_set(t) for t in texts]
    for i, a in enumerate(sets):
        for b in sets[:i]:
            assert 100 * len(a & b) < 90 * len(a | b) or not a
    last = corpus_pipeline.run(spark, SF).collect()
    assert last and "sequence_id" in last[0]


def _five_word_runs(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_pipeline_of_odd_rows(spark, odd):
    """Stages on odd rows, with columns named like those a stage might use."""
    import corpus_pipeline

    names = ("cuts", "_id", "_copy", "_source", "_words", "row", "number", "words", "copy", "rank", "size", "at", "token", "a.b")
    docs = odd
    for i, name in enumerate(names):
        docs = docs.withColumn(name, F.lit(i))
    rows = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert rows.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in rows.collect()), key=repr)
    texts = {d: t for d, t, *_ in ODD}
    groups = {}
    for d, t in texts.items():
        key = frozenset(_five_word_runs(t or "")) or d
        key = frozenset(_five_word_runs(BASE)) if d in (1, 2) else key
        if d is not None:
            groups[key] = min(groups.get(key, d), d)
    expected = [(d, texts[d]) for d in groups.values()] + [(None, BASE)]
    assert got == sorted(expected, key=repr)
    mix = corpus_pipeline.mixed(spark, docs, SF)
    assert mix.columns == docs.columns
    taken = {}
    for r in mix.collect():
        taken[r.source] = taken.get(r.source, 0) + len((r.text or "").split())
        assert r.n_chars == len(r.text)
    sizes = mixing.document_sizes(docs.withColumn("doc_id", F.monotonically_increasing_id()))
    assert taken == {r.source: round(r.target) for r in mixing.weighted_targets(sizes).collect() if round(r.target)}
    empty = docs.where("doc_id > 100")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).collect() == [], name


def test_mix_of_rows_without_ids(spark):
    """Rows with a null or repeated doc_id are cut each by its own words."""
    import corpus_pipeline

    rng = np.random.default_rng(4)
    rows = []
    for i in range(240):
        words = " ".join(f"r{i}w{k}" for k in range(int(rng.integers(1, 400))))
        rows.append((None if i % 3 == 0 else 7 if i % 3 == 1 else i, words, "en", "abc"[i % 3], 0, "x"))
    docs = spark.createDataFrame(rows, DOCS)
    got = corpus_pipeline.mixed(spark, docs, SF).collect()
    by_row = {}
    for r in got:
        words = r.text.split()
        (owner,) = {int(re.match(r"r(\d+)w", w).group(1)) for w in words}
        by_row.setdefault(owner, []).append([int(w.split("w")[1]) for w in words])
    taken = {s: 0 for s in "abc"}
    for owner, passes in by_row.items():
        assert len(passes) <= 2
        for positions in passes:
            assert positions == sorted(set(positions)) and positions[-1] < len(rows[owner][1].split())
            taken[rows[owner][3]] += len(positions)
    sizes = mixing.document_sizes(docs.withColumn("doc_id", F.monotonically_increasing_id()))
    assert taken == {r.source: round(r.target) for r in mixing.weighted_targets(sizes).collect()}


def test_packing_of_the_mix(spark, odd):
    """The last stage holds every id of what the stage before it gave, once."""
    import corpus_pipeline
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(packing.tokenizer_path())
    docs = corpus_pipeline.mixed(spark, odd, SF).persist()
    rows = corpus_pipeline.packed(spark, docs, SF).collect()
    ids = sum(len(whole.encode(r.text, add_special_tokens=False).ids) + 1 for r in docs.collect())
    assert sum(r.length for r in rows) == ids
    per = {}
    for r in rows:
        per.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(n for _, n in p) <= packing.WINDOW for p in per.values())


def test_near_duplicates_five_words(spark):
    import corpus_pipeline

    def runs(text):
        words = text.split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}

    rng = np.random.default_rng(3)
    texts = {}
    for group in range(12):
        words = [f"g{group}w{i}" for i in range(50 + 25 * group)]
        for edits in (0, 1, 1 + len(words) // 50, 1 + len(words) // 25):
            new = list(words)
            for at in rng.choice(len(words), edits, replace=False):
                new[at] = f"e{len(texts)}x{at}"
            texts[len(texts)] = " ".join(new)
    # One word of 50 changed: 45 of 51 runs of three words, 41 of 51 of five.
    texts[90] = " ".join(f"p{i}" for i in range(50))
    texts[91] = texts[90].replace("p20 ", "other ")
    sets = {d: runs(t) for d, t in texts.items()}
    label = {d: d for d in texts}
    for _ in texts:
        for a in texts:
            for b in texts:
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    label[a] = label[b] = min(label[a], label[b])
    rows = [(d, t, "en", "a", len(t), "x") for d, t in texts.items()]
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, DOCS), SF)
    kept = {r.doc_id for r in kept.collect()}
    assert kept == {d for d, c in label.items() if d == c}
    assert 90 in kept and 91 not in kept


@pytest.mark.parametrize("blocks", [1, 2, 3, 5, 7, 100, 239, 5826, 5827, 11654, 65536, 273919])
def test_each_block_once_a_pass(spark, blocks):
    for no in range(2):
        key = (F.lit(blocks).cast("long"), F.lit(2), F.lit(no))
        rows = spark.range(blocks).select("id", mixing.permuted(F.col("id"), *key).alias("block"))
        rows = rows.withColumn("back", mixing.permuted(F.col("block"), *key, back=True))
        got = rows.agg(F.count_distinct("block"), F.min("block"), F.max("block"), F.count_if(F.col("id") != F.col("back"))).first()
        assert got[:] == (blocks, 0, blocks - 1, 0)


def test_permutations_differ(spark):
    """Neither a rotated or mirrored identity, nor shared by sources or passes."""
    blocks = F.lit(200).cast("long")
    columns = [mixing.permuted(F.col("id"), blocks, F.lit(r), F.lit(p)).alias(f"b{r}{p}") for r in (0, 1) for p in (0, 1)]
    rows = spark.range(200).select("id", *columns).orderBy("id").collect()
    orders = [[r[c] for r in rows] for c in ("b00", "b01", "b10", "b11")]
    assert len({tuple(o) for o in orders}) == 4
    for order in orders:
        steps = {(b - a) % 200 for a, b in zip(order, order[1:], strict=False)}
        assert len(steps) > 60


def test_shard_counts_are_a_draw(spark):
    """Counts add up to the totals, spread as a draw does, and fix each shard's slots."""
    docs = spark.range(40_000).select(
        F.col("id").alias("doc_id"), F.lit(100).cast("long").alias("size"), (F.col("id") % 4).cast("string").alias("source")
    )
    targets = mixing.weighted_targets(docs)
    ranked = docs.join(targets, "source").select("doc_id", "rank", "size")
    mix = mixing.mixture(ranked, targets)
    slots = mix.select("shard", "rank", "pass", "block").distinct().groupBy("rank", "shard").count().collect()
    shards = len({r.shard for r in slots})
    assert shards == -(-6_000_000 // (128 * 1024))
    for rank in range(4):
        n = np.array([r["count"] for r in slots if r["rank"] == rank])
        mean = n.sum() / shards
        assert 0.4 < ((n - mean) ** 2).sum() / (mean * (1 - 1 / shards)) / (shards - 1) < 2.2
    words = {r["rank"]: r.words for r in mix.groupBy("rank").agg(F.sum("words").alias("words")).collect()}
    owed = {r["rank"]: round(r.target) for r in targets.collect()}
    assert words == owed


@pytest.mark.parametrize("blocks", [5827, 11654])
def test_mixing_of_factor_blocks(spark, blocks):
    docs = spark.range(blocks).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), 128).alias("text"), F.lit("a").alias("source")
    )
    docs = docs.withColumn("rank", F.lit("x")).withColumn("at", F.lit(0)).withColumn("block", F.lit(None))
    got = mixing.mix_documents(docs).agg(F.sum("taken"), F.min("taken"), F.max("taken")).first()
    assert got[:] == (blocks * 192, 128, 256)


def test_graph_recall_of_the_beam():
    x = np.random.default_rng(4).normal(size=(6000, 64))
    q = x[::20]
    found, _ = ann.search_graph(x, ann.build_graph(x), q, 20, ann.BEAM)
    true = np.argsort(-(q @ x.T), axis=1)[:, :20]
    assert np.mean([np.isin(t, f).mean() for t, f in zip(true, found, strict=True)]) >= 0.91


def test_nearest_with_many_copies(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(900, 16))
    x[100:500] = x[100]  # 400 copies
    x[500:560] = x[500]
    x[560:570] = x[560]
    x[7], x[300] = 3 * x[100], x[100]  # the copies are the nearest of query 0 below
    x[0] = x[100] + rng.normal(size=16) * 0.01
    x = x[np.concatenate([[0], 1 + rng.permutation(899)])]  # ids of copies lie apart
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    found = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=5).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append(r.vec_id)
    product = np.einsum("nd,kd->nk", x, x)
    _, same = np.unique(x, axis=0, return_inverse=True)
    first = np.unique(same, return_index=True)[1][same.ravel()]
    product = product[:, first]  # copies have one product
    assert sorted(got) == list(range(0, 900, 5))
    for q, ids in got.items():
        best = [int(v) for v in np.lexsort((np.arange(900), -product[q])) if v != q][:20]
        assert ids == best, q


def _norm_cases():
    rng = np.random.default_rng(12)
    plain = rng.normal(size=(5000, 64))
    yield "equal", plain / np.linalg.norm(plain, axis=1, keepdims=True)
    yield "normal", plain
    for sigma in (1, 2):
        yield f"lognormal {sigma}", plain * rng.lognormal(0, sigma, (5000, 1))
    for spread in (0.02, 0.2):
        centres = rng.normal(size=(25, 64))
        yield f"25 clusters {spread}", centres[rng.integers(0, 25, 5000)] + rng.normal(size=(5000, 64)) * spread
    yield "many small clusters", rng.normal(size=(400, 64))[rng.integers(0, 400, 5000)] + rng.normal(size=(5000, 64)) * 0.01


@pytest.mark.parametrize("name, x", list(_norm_cases()), ids=lambda v: v if isinstance(v, str) else "")
def test_recall_of_a_shard(name, x):
    q = x[::33]
    shard = ann.Shard.unpacked(ann.Shard(np.arange(5000), x).packed())
    found, score = shard.search(q, 20, ann.BEAM)
    ids = shard.ids[found]
    product = q @ x.T
    kth = np.sort(product, axis=1)[:, -20]
    true = np.argsort(-product, axis=1)[:, :20]
    recall = np.array([np.isin(t, f).mean() for t, f in zip(true, ids, strict=True)])
    print(name, recall.mean(), recall.min())
    assert recall.mean() >= 0.95 and recall.min() >= 0.5
    assert np.allclose(score, np.take_along_axis(product, ids, 1)) and (kth > -np.inf).all()


def test_beam_holds_a_node_once():
    x = np.random.default_rng(2).normal(size=(300, 24))
    found, _ = ann.search_graph(x, ann.build_graph(x), x[:20], 20, ann.BEAM)
    assert all(len(set(f[f >= 0].tolist())) == (f >= 0).sum() for f in found)
