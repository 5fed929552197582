"""One query per operator over its whole table, and the same results in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import (
    ann,
    chat,
    collocations,
    embed_dedup,
    hard_negatives,
    langid,
    mixing,
    ngram_join,
    packing,
    quality,
    substring_dedup,
    url_lists,
    warc,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages"))


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def page_captures(pages: DataFrame) -> DataFrame:
    """Pages as captures; the tables have no fetch time, so the id spreads them over 2024."""
    day = F.expr("date_add(date'2024-01-01', cast(pmod(page_id * 37, 366) as int))")
    return pages.select(F.col("page_id").alias("capture_id"), "url", day.alias("fetched"))


def page_list_entries(pages: DataFrame) -> DataFrame:
    """Dated list entries for every host, parent domain, first path and whole path of the pages.

    Each pattern is listed, dropped, and for some listed again, on days that
    follow from the smallest page id it has.
    """
    url = F.col("url")
    host = F.lower(F.regexp_extract(url, url_lists.PARTS, 1))
    labels = F.split(host, r"\.")
    steps = F.filter(F.split(F.regexp_extract(url, url_lists.PARTS, 2), "/"), lambda s: s != "")
    deep = F.when(F.size(steps) > 1, F.concat(host, F.lit("/"), F.array_join(steps, "/")))
    parent = F.when(F.size(labels) >= 4, F.array_join(F.slice(labels, F.size(labels) - 2, 3), "."))
    kinds = F.array(
        F.struct(F.lit("hosts").alias("list"), host.alias("pattern")),
        F.struct(F.lit("domains").alias("list"), parent.alias("pattern")),
        F.struct(F.lit("paths").alias("list"), F.concat(host, F.lit("/"), F.try_element_at(steps, F.lit(1))).alias("pattern")),
        F.struct(F.lit("pages").alias("list"), deep.alias("pattern")),
    )
    patterns = pages.where(host != "").select("page_id", F.explode(kinds).alias("p")).select("page_id", "p.*")
    first = patterns.where("pattern IS NOT NULL").groupBy("list", "pattern").agg(F.min("page_id").alias("first"))
    listed = "named_struct('day', date_add(date'2024-01-01', cast({0} as int)), 'seq', {1}, 'listed', {2})"
    states = F.expr(
        "array("
        + listed.format("pmod(first, 180)", 0, "true")
        + ","
        + listed.format("pmod(first, 180) + 30 + pmod(first, 60)", 1, "false")
        + ","
        + listed.format("pmod(first, 180) + 150", 2, "pmod(first, 3) = 0")
        + ")"
    )
    return first.select("list", "pattern", F.explode(states).alias("s")).select("list", "pattern", "s.*")


def op6_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_lists.evaluate_captures(page_captures(pages), page_list_entries(pages))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_language(table(spark, sf_dir, "documents"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)],
        "conv_id long, turn long, role string, text string",
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.format_conversations(rows.unionByName(extra)))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine_hard_negatives(table(spark, sf_dir, "embeddings"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeated(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_join,
        op2_mixing,
        op3_embedding_dedup,
        op4_warc,
        op5_ann,
        op6_url_lists,
        op7_quality,
        op8_packing,
        op9_language,
        op10_chat,
        op11_hard_negatives,
        op12_substring_dedup,
        op13_collocations,
    )
}



def _network(x: str) -> str:
    """Four Feistel rounds on ``x`` in SQL."""

    def more(part: str, no: int, by: str, size: str) -> str:
        key = f"rank || ':' || pass || ':{no}:' || ({by})"
        return f"(({part}) + ('0x' || left(md5({key}), 8))::BIGINT) % {size}"

    left, right = f"{x} // b", f"{x} % b"
    left = more(left, 0, right, "a")
    right = more(right, 1, left, "b")
    left = more(left, 2, right, "a")
    right = more(right, 3, left, "b")
    return f"(({left}) * b + {right})"


_CLOSURE = """
, reach(id, other) AS (
  SELECT id, id FROM nodes UNION SELECT r.id, e.b FROM reach r JOIN edges e ON e.a = r.other
), component AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
"""

LLM_ORACLES: dict[str, str] = {
    "op1_ngram_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) END AS s FROM w
), size AS (SELECT doc_id AS id, len(s) AS n FROM s), one AS (SELECT doc_id, unnest(s) AS g FROM s),
nodes AS (SELECT id FROM size), edges AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM one x JOIN one y ON x.g = y.g AND x.doc_id <> y.doc_id
  JOIN size p ON p.id = x.doc_id JOIN size q ON q.id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, p.n, q.n HAVING 100 * count(*) >= 90 * (p.n + q.n - count(*))
)"""
    + _CLOSURE
    + "SELECT id AS doc_id, n AS n_shingles, component_id FROM size JOIN component USING (id)",
    "op2_mixing": r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM d GROUP BY source
), w AS (SELECT *, [5, 2, 1][rank % 3 + 1] AS weight FROM s),
v AS (
  SELECT *, sum(source_size) OVER () * 1.5::DOUBLE AS total,
    2 * coalesce(sum(source_size) OVER before, 0) AS filled,
    sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS rest
  FROM w WINDOW before AS (ORDER BY source_size::DOUBLE / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (SELECT *, (total - filled) / rest AS level FROM v),
f AS (SELECT arg_min(level, filled) AS level FROM l WHERE level * weight < 2 * source_size),
t AS (
  SELECT source, rank, source_size, CASE WHEN f.level IS NULL THEN 2.0 * source_size
    ELSE least(2.0 * source_size, f.level * weight) END::DOUBLE AS target
  FROM w, (SELECT max(level) AS level FROM f) f
), laid AS (
  SELECT doc_id, rank, size, source_size, target, coalesce(sum(size) OVER (PARTITION BY rank
    ORDER BY ((doc_id % 1024) + 1024) % 1024, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), k AS (SELECT rank, source_size AS words, (source_size + 127) // 128 AS blocks, round(target)::BIGINT AS owed FROM t),
sized AS (SELECT *, ceil(sqrt(blocks))::BIGINT AS a, ceil(blocks / ceil(sqrt(blocks)))::BIGINT AS b,
  greatest(1, ceil(sum(owed) OVER () / 131072))::BIGINT AS shards FROM k),
slots AS (
  SELECT k.*, p.p AS pass, unnest(range(blocks)) AS turn FROM sized k, (VALUES (0), (1)) p(p) WHERE words > 0
), placed AS (
  SELECT *, list_reduce(list_prepend(""" + _network("turn") + """, range(72)),
    lambda x, i: CASE WHEN x < blocks THEN x ELSE """ + _network("x") + """ END) AS block FROM slots
), last AS (SELECT rank, pass, turn AS short_turn FROM placed WHERE block = blocks - 1),
left_over AS (
  SELECT rank, pass, turn, block, blocks, shards, owed - (pass * words + turn * 128
    - CASE WHEN turn > short_turn THEN blocks * 128 - words ELSE 0 END) AS owing
  FROM placed JOIN last USING (rank, pass)
), drawn AS (
  SELECT rank, ('0x' || left(md5('shard:' || rank || ':' || (pass * blocks + turn)), 8))::BIGINT % shards AS shard
  FROM left_over WHERE owing > 0
), dealt AS (SELECT rank, shard, row_number() OVER (PARTITION BY rank ORDER BY shard) - 1 AS slot FROM drawn),
piece AS (
  SELECT doc_id, rank, pos, size, unnest(range(pos // 128, (pos + size - 1) // 128 + 1)) AS block FROM laid WHERE size > 0
), cut AS (
  SELECT doc_id, rank, block, greatest(pos, block * 128) - block * 128 AS first,
    least(pos + size, block * 128 + 128) - greatest(pos, block * 128) AS length FROM piece
), took AS (
  SELECT doc_id, rank, sum(least(length, owing - first))::BIGINT AS taken, count(DISTINCT shard) AS shards
  FROM cut JOIN left_over USING (rank, block) JOIN dealt USING (rank)
  WHERE dealt.slot = pass * blocks + turn AND owing > first GROUP BY doc_id, rank
)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken, coalesce(shards, 0) AS shards
FROM laid LEFT JOIN took USING (doc_id, rank)
""",
    "op3_embedding_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), nodes AS (SELECT vec_id AS id FROM embeddings), edges AS (
  SELECT x.id AS a, y.id AS b FROM v x JOIN v y ON x.id <> y.id AND list_cosine_similarity(x.v, y.v) >= 0.9
)"""
    + _CLOSURE
    + """
SELECT id AS vec_id, (SELECT count(*) FROM edges WHERE a = c.id) AS n_links, component_id, id = component_id AS kept
FROM component c""",
    "op4_warc": """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first < page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
""",
    "op6_url_lists": r"""
WITH u AS (
  SELECT page_id, (DATE '2024-01-01' + (((page_id * 37) % 366)::INT))::DATE AS fetched,
    lower(regexp_extract(url, '(?i)^https?://(?:[^/?#@]*@)?([^/?#:]+)(?::[0-9]*)?([^?#]*)', 1)) AS host,
    list_filter(string_split(regexp_extract(url, '(?i)^https?://(?:[^/?#@]*@)?([^/?#:]+)(?::[0-9]*)?([^?#]*)', 2), '/'),
      lambda x: x <> '') AS steps
  FROM pages
), h AS (SELECT *, string_split(host, '.') AS labels FROM u WHERE host <> ''),
k AS (
  SELECT 'hosts' AS list, host AS pattern, page_id FROM h
  UNION ALL SELECT 'domains', array_to_string(labels[-3:], '.'), page_id FROM h WHERE len(labels) >= 4
  UNION ALL SELECT 'paths', host || '/' || steps[1], page_id FROM h WHERE len(steps) > 0
  UNION ALL SELECT 'pages', host || '/' || array_to_string(steps, '/'), page_id FROM h WHERE len(steps) > 1
), f AS (SELECT list, pattern, min(page_id) AS first FROM k GROUP BY list, pattern),
e AS (
  SELECT list, pattern, first % 180 AS day, 0 AS seq, true AS listed FROM f
  UNION ALL SELECT list, pattern, first % 180 + 30 + first % 60, 1, false FROM f
  UNION ALL SELECT list, pattern, first % 180 + 150, 2, first % 3 = 0 FROM f
), i AS (
  SELECT list, pattern, listed, (DATE '2024-01-01' + day::INT)::DATE AS start,
    coalesce((DATE '2024-01-01' + (lead(day) OVER (PARTITION BY list, pattern ORDER BY day, seq))::INT)::DATE,
      DATE '9999-12-31') AS stop FROM e
), c AS (
  SELECT page_id, fetched, unnest([array_to_string(labels[j:], '.') FOR j IN range(1, greatest(2, len(labels)))]) AS pattern FROM h
  UNION SELECT page_id, fetched, unnest([host || '/' || array_to_string(steps[:j], '/') FOR j IN range(1, len(steps) + 1)]) FROM h
), m AS (
  SELECT page_id, count(*) AS n, arg_max(c.pattern, (length(c.pattern), c.pattern)) AS matched
  FROM c JOIN i ON c.pattern = i.pattern AND i.listed AND start <= fetched AND fetched < stop GROUP BY page_id
)
SELECT page_id AS capture_id, fetched, coalesce(n, 0) AS n_active, n IS NOT NULL AS blocked, matched
FROM u LEFT JOIN m USING (page_id)
""",
    "op10_chat": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), l AS (
  SELECT *, length(text) + length(text) - length(replace(text, '\', ''))
    + length(text) - length(replace(text, '#', '')) - len(regexp_extract_all(text, '#+'))
    + (length(text) - length(replace(text, '</turn>', ''))) // 7
    + length(role) + len(regexp_extract_all(role, '[\\#\n\r:<]')) + 14 AS chars FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM l GROUP BY conv_id
""",
    "op11_hard_negatives": """
WITH e AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.id AS anchor_id, a.label AS own, b.id, b.label, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM e a JOIN e b ON len(a.q) = len(b.q) AND a.id <> b.id WHERE a.id % 100 = 0
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id,
  (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id))::INTEGER AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE label <> own AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
""",
    "op12_substring_dedup": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), one AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
win AS (
  SELECT doc_id, pos, word, list(word) OVER run AS run
  FROM one WINDOW run AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)
), seen AS (
  SELECT doc_id, pos, word, len(run) = 20 AND row_number() OVER (PARTITION BY run ORDER BY doc_id, pos) > 1 AS later
  FROM win
), gone AS (
  SELECT doc_id, pos, word, coalesce(bool_or(later) OVER (PARTITION BY doc_id ORDER BY pos
    ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), false) AS gone FROM seen
), left_over AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept
  FROM gone GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN left_over USING (doc_id)
""",
    "op13_collocations": r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (
  SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
  FROM w, range(1, 6) t(k) WHERE len(w) >= k
), f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY lang, k, phrase HAVING count(*) >= 100),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
c AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE k >= 2),
cut AS (SELECT *, unnest(range(1, k)) AS cut FROM c),
s AS (
  SELECT cut.lang, cut.phrase, cut.a, n.n, cut, x.f AS l, y.f AS r,
    (1000::HUGEINT * cut.a * n.n // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cut JOIN n ON n.lang = cut.lang
  JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(cut.w[:cut], ' ')
  JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(cut.w[cut + 1:], ' ')
  QUALIFY row_number() OVER (PARTITION BY cut.lang, cut.phrase ORDER BY score, cut) = 1
), kept AS (
  SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.lang = s.lang AND c.a >= s.a
    AND len(c.phrase) > len(s.phrase) AND contains(' ' || c.phrase || ' ', ' ' || s.phrase || ' '))
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score FROM kept QUALIFY rank <= 2000
""",
}
