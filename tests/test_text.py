from __future__ import annotations

import html
import json
import unicodedata

import pyarrow as pa
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedloom.functions.redaction import KEY_PARTS, PATTERNS, looks_like_secret, mask_secret, may_hold_key, secret_words
from feedloom.functions.scalars import is_infinite, safe_int, strict_int
from feedloom.functions.text import FOLDED, ZERO_WIDTH, _decode_column, _decode_json, _decode_lists, _each, decode_lists, normalize_text, normalize_texts
from feedloom.operators.redact import redact_table, secret_report
from feedloom.session import configure

RELAXED = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


PIECES = st.sampled_from(
    [
        "word", "Ünï", " ", "  ", "\t", "\n", "\n\n\n", "\r\n", "—", "…", "“", "»", " ", "​",
        "­", " ", "\x1c", "&amp;", "&amp;lt;", "&copy", "&#8203;", "&hellip;", "ﬁ", "①", "ｈttps",
        "https://t.co/Ab1", "http://t.co/x_y", " https://t.co/", "https://t.co/é", "é", "é", "&", "<b>",
    ]
)
TEXTS = st.lists(st.one_of(PIECES, st.characters(exclude_categories=("Cs",))), max_size=12).map("".join)

# Input and expected text, worked out by hand.
EXAMPLES = [
    (None, ""),
    ("", ""),
    ("Wait\u2014what\u2026 https://t.co/zz9", "Wait--what..."),
    ("a https://t.co/one https://t.co/two", "a https://t.co/one"),
    ("https://t.co/only", ""),
    ("&amp;lt; &lt;", "&lt; <"),
    ("x\n\n\n\ny", "x\n\ny"),
    (" \t x  ", "x"),
    ("&nbsp;x&nbsp;", "x"),
    ("\u201cq\u201d \u2018r\u2019", "\"q\" 'r'"),
    ("\u00abq\u00bb 1\u20132", "\"q\" 1-2"),
    ("so\u00adft\u200b", "soft"),
    ("\ufb01n \u2460", "fin 1"),
    ("keep http://t.co/a b", "keep http://t.co/a b"),
]


def run_normalize(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = frame.select("i", normalize_text(F.col("t")).alias("n")).collect()
    return [r.n for r in sorted(rows)]


def test_normalize_examples(spark):
    assert run_normalize(spark, [t for t, _ in EXAMPLES]) == [n for _, n in EXAMPLES]


@RELAXED
@given(st.lists(TEXTS, min_size=20, max_size=60))
def test_normalize_any_text(spark, texts):
    for clean in run_normalize(spark, texts):
        assert clean == clean.strip()
        assert not set("\u2018\u2019\u201c\u201d\u2014\u2026\u200b\u00ad") & set(clean)
        assert "  " not in clean and "\t" not in clean and "\n\n\n" not in clean


def test_normalize_arrays(spark):
    frame = spark.createDataFrame([(1, ["a&amp;b", None, " x "]), (2, None), (3, ["q"])], "i int, ts array<string>")
    rows = frame.select("i", normalize_texts(F.col("ts")).alias("n")).collect()
    assert {r.i: r.n for r in rows} == {1: ["a&b", "", "x"], 2: None, 3: ["q"]}


def test_links_at_the_end(spark):
    kept = ["x://t.co/a", "https://t.co/a b", "https://t.co/", "https://t.co/a/", "http//t.co/a", "https://t.co/a-b"]
    cut = {"https://t.co/a": "", "q\u3000http://t.co/\u00e9_1 \u2003": "q", "://t.co/ https://t.co/b": "://t.co/", "xhttps://t.co/b": "x"}
    assert run_normalize(spark, kept + list(cut)) == kept + list(cut.values())


def test_every_code_point_decodes_as_alone():
    """A whole column at a time gives what each text gives by itself."""
    chars = [c for c in map(chr, range(0x110000)) if not 0xD800 <= ord(c) < 0xE000 and unicodedata.category(c) != "Cn"]
    texts = [*chars, *(f"e{c}\u0301" for c in chars[:20_000]), "&amp;lt;", "&#x2014;", None, "&", "&copy"]
    plain = [t if t is None else html.unescape(unicodedata.normalize("NFKC", t)) for t in texts]
    expected = [t if t is None else "".join(FOLDED.get(c, "" if c in ZERO_WIDTH else c) for c in t) for t in plain]
    assert _decode_column(pa.array(texts, pa.string())).to_pylist() == expected
    lists = pa.array([["\u2014", None], None, [], ["&lt;"]], pa.list_(pa.string()))
    assert _decode_lists(lists).to_pylist() == [["--", None], None, [], ["<"]]
    assert _decode_lists(lists.slice(1)).to_pylist() == [None, [], ["<"]]


def test_long_blank_runs_stay_fast(spark):
    text = "a" + " \r" * 100_000 + "b" + "\n" * 100_000
    assert run_normalize(spark, [text]) == ["a" + " \r" * 100_000 + "b"]


# ── integers ─────────────────────────────────────────────────────────────


@RELAXED
@given(st.lists(st.integers(-(10**18), 10**18), min_size=20, max_size=40), st.integers(0, 10**30))
def test_safe_int_truncates(spark, numbers, fraction):
    """Grouping commas and fractions of any length change nothing."""
    texts = [f(n) for n in numbers for f in (str, "{:,}".format, f"{{}}.{fraction}".format)]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = frame.select("i", safe_int(F.col("t")).alias("n")).collect()
    assert [r.n for r in sorted(rows)] == [n for n in numbers for _ in range(3)]


def test_safe_int_examples(spark):
    expected = {
        "": 0, " 7 ": 7, "+5": 5, "1e3": 1000, "1.5e2": 150, "nan": 0, "x1": 0, "1.2.3": 0, "--1": 0,
        "12.9999999999999999999": 12, "-0.5": 0, ".5": 0, "-3.99": -3, ".": 0,
    }
    frame = spark.createDataFrame([(t,) for t in expected], "t string")
    rows = frame.select("t", safe_int(F.col("t")).alias("n")).collect()
    assert {r.t: r.n for r in rows} == expected


def test_other_integers(spark):
    texts = ["12", "1,234", "12.9", None, " inf ", "-Infinity", "infinite"]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = frame.select("i", strict_int(F.col("t"), -1).alias("n"), is_infinite(F.col("t")).alias("inf")).collect()
    assert [r.n for r in sorted(rows)] == [12, -1, -1, -1, -1, -1, -1]
    assert [r.inf for r in sorted(rows)] == [False, False, False, False, True, True, False]


# ── redaction ────────────────────────────────────────────────────────────

# Text, its plain and its strict redaction, worked out by hand.
LINES = [
    ("token=12345678", "token=********", "token=********"),
    ("Token: '123456789' x", "Token=1234**789' x", "Token=1234**789' x"),
    ("password = \"abc", "password=***", "password=***"),
    ("ct0:ab cookie=cd", "ct0=** cookie=**", "ct0=** cookie=**"),
    ("api_key=Bearer 123456789", "api_key=****** 123456789", "api_key=1234*6789"),
    ("secret=$1\\\\2", "secret=*****", "secret=*****"),
    ("tokens are fine", "tokens are fine", "tokens are fine"),
    ("nothing", "nothing", "nothing"),
]


def test_redact_text(spark):
    frame = spark.createDataFrame([(i, t[0], t[0]) for i, t in enumerate(LINES)], "i int, t string, u string")
    plain = redact_table(frame, ["t"], mode="plain")
    both = sorted(redact_table(plain, ["u"], mode="strict").collect())
    assert [(r.t, r.u) for r in both] == [(p, s) for _, p, s in LINES]


@RELAXED
@given(st.lists(st.text(st.characters(min_codepoint=33, max_codepoint=126, exclude_characters="\"'=:"), min_size=1), min_size=5, max_size=20))
def test_only_the_secret_changes(spark, secrets):
    frame = spark.createDataFrame([(i, f"see token={x} end") for i, x in enumerate(secrets)], "i int, t string")
    for r in redact_table(frame, ["t"], mode="plain").collect():
        kept = r.t.removeprefix("see token=").removesuffix(" end")
        secret = secrets[r.i]
        assert len(kept) == len(secret) and "*" in kept
        assert all(a in (b, "*") for a, b in zip(kept, secret, strict=True))


def test_authorization_header(spark):
    frame = spark.createDataFrame([("Authorization: Bearer abcdefghij",)], "t string")
    assert redact_table(frame, ["t"], "plain").first().t == "Authorization=****** abcdefghij"
    assert redact_table(frame, ["t"], "strict").first().t == "Authorization=abcd**ghij"


def test_redact_collections(spark):
    frame = spark.createDataFrame(
        [({"TOKEN": "123456789", "city": "x" * 50, "apikey": "abc", "ct0": None}, ["a" * 39, "a" * 40, "b c", None, "f" * 40 + "\n"])],
        "m map<string,string>, a array<string>",
    )
    row = redact_table(frame, ["m", "a"]).first()
    assert row.m == {"TOKEN": "1234*6789", "city": "x" * 50, "apikey": "***", "ct0": None}
    assert row.a == ["a" * 39, "aaaa" + "*" * 32 + "aaaa", "b c", None, "ffff" + "*" * 33 + "fff\n"]


def test_mask_lengths(spark):
    frame = spark.createDataFrame([("",), ("12345678",), ("123456789",)], "t string")
    assert [r[0] for r in frame.select(mask_secret(F.col("t"))).collect()] == ["", "********", "1234*6789"]


def test_secret_report(spark):
    texts = ["token=a Token: b", "password=x " + "A" * 40 + " " + "b" * 39, None, "nothing"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = {(r.kind, r.finding): r.n for r in secret_report(frame, "t").collect()}
    assert rows == {("key", "token"): 2, ("key", "password"): 1, ("token", "token"): 1}


def test_cheap_test_misses_no_key(spark):
    """Whatever letter stands in a key, a text that the search would find passes."""
    keys = F.explode(F.array(*map(F.lit, ("cookie", "bearer", "token", "api_key", "password", "authorization"))))
    odd = [(chr(c),) for c in (*range(0x80, 0x3000), *range(0xA640, 0xAB70), *range(0xFF00, 0xFF60))]
    texts = spark.createDataFrame(odd, "c string").select("c", keys.alias("key"))
    texts = texts.withColumn("at", F.explode(F.sequence(F.lit(1), F.length("key"))))
    text = F.concat(F.expr("left(key, at - 1)"), F.col("c"), F.expr("substring(key, at + 1)"), F.lit("=x"))
    found = texts.select(text.alias("t")).where(F.col("t").rlike(PATTERNS["plain"]))
    assert found.count() >= 10
    assert found.where(~may_hold_key(F.col("t"))).collect() == []
    assert len(KEY_PARTS) == len(set(KEY_PARTS))


def test_marks_do_not_show(spark):
    texts = ["\x01token=abc\x01", "token=$1 \\2 secret: 'q", "token=a token=b\ntoken:c", "Token : \"abcdefghijkl", None, "", "tokens"]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r.t for r in sorted(redact_table(frame, ["t"], "plain").collect())]
    assert got == ["\x01token=****", "token=** \\2 secret=*", "token=* token=*\ntoken=*", "Token=abcd****ijkl", None, "", "tokens"]
    plan = redact_table(frame, ["t"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 1 and "rlike" not in plan.lower() and "regexp_extract" not in plan


def test_secret_words(spark):
    run = "a" * 40
    texts = [run, f"x {run}\u3000{run[:39]}", f"{run}!", f"!{run}", f"{run}\n{run}==", ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = frame.select("i", secret_words(F.col("t")).alias("w"), F.filter(F.split("t", r"(?U)\s+"), looks_like_secret).alias("v")).collect()
    assert all(r.w == r.v for r in rows) and [len(r.w) for r in sorted(rows)] == [1, 1, 0, 0, 2, 0]


def test_lists_reach_python_as_text(spark):
    """Spark's Arrow writer walks a list column from its start for every row of a batch."""
    import pyarrow as pa

    assert decode_lists.returnType.simpleString() == "string"
    texts = pa.array(['["\u2014",null,"a&lt;"]', None, "[]"], pa.string())
    assert [t and json.loads(t) for t in _decode_json(texts).to_pylist()] == [["--", None, "a<"], None, []]
    rows = spark.createDataFrame([(1, ["\u201cx\u201d", None, "\x00 &amp; \\"]), (2, None), (3, [])], "i int, t array<string>")
    got = {r.i: r.n for r in rows.select("i", normalize_texts(F.col("t")).alias("n")).collect()}
    assert got == {1: ['"x"', "", "\x00 & \\"], 2: None, 3: []}


def test_texts_are_decoded_few_at_a_time():
    """A batch's texts are never all Python text at once."""
    import tracemalloc

    import pyarrow as pa

    texts = pa.array(["\u4e00" * 100_000] * 100, pa.string())
    tracemalloc.start()
    assert _decode_column(texts).equals(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 15_000_000  # all at once: 50 MB and more


def test_batches_to_python_are_bounded(spark):
    """A worker holds a few hundred texts at once, however many rows its task has; less stays less."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        for given, kept in (("10000", "256"), ("0", "256"), ("100", "100")):
            spark.conf.set(key, given)
            assert configure(spark).conf.get(key) == kept
    finally:
        spark.conf.set(key, before)


def test_batch_without_texts_is_not_taken_apart():
    def change(text):
        raise AssertionError("no text to change")

    for n in (0, 1, 300):
        assert _each(pa.nulls(n, pa.string()), change).equals(pa.nulls(n, pa.string()))
    assert _decode_column(pa.array([None, "\u2014"])).to_pylist() == [None, "--"]
