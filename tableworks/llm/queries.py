"""The queries of this subpackage: op1 to op13 and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.catalog import Tables
from ..session import prepare_session
from . import decontaminate, divergence, embeddings, minhash, mixing, pii, planes, prefix_bpe, quality, sharding, toxicity, trie, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Rows per Arrow batch: long texts must fit a Python worker many at a time.
ARROW_ROWS = "500"


def session(spark: SparkSession) -> SparkSession:
    prepare_session(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return spark


def query(name: str, sql: str | None = None):
    def keep(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(session(spark), folder))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


@query("op1_mix_sources", r"""
WITH RECURSIVE base AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || '/mix'), 1, 13) AS BIGINT) AS draw
  FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM base GROUP BY source),
named AS (
  SELECT source, source_size, [5, 2, 1][1 + (row_number() OVER (ORDER BY source COLLATE C NULLS LAST) - 1) % 3] AS weight FROM sizes),
levels AS (SELECT *, source_size * 2 AS full_size, CAST(source_size * 2 AS DOUBLE) / weight AS full_at FROM named),
sums AS (
  SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE AS wanted,
         CAST(sum(full_size) OVER (ORDER BY full_at, source COLLATE C NULLS LAST ROWS UNBOUNDED PRECEDING) - full_size AS BIGINT) AS full_before,
         CAST(sum(weight) OVER () - sum(weight) OVER (ORDER BY full_at, source COLLATE C NULLS LAST ROWS UNBOUNDED PRECEDING) + weight AS BIGINT) AS weight_left
  FROM levels),
capped AS (SELECT *, (wanted - full_before) / weight_left * weight >= full_size AS is_capped FROM sums),
opened AS (
  SELECT *, CAST(coalesce(sum(CASE WHEN is_capped THEN full_size END) OVER (), 0) AS BIGINT) AS capped_size,
         CAST(sum(CASE WHEN NOT is_capped THEN weight END) OVER () AS BIGINT) AS open_weight FROM capped),
targets AS (
  SELECT source, source_size, CASE WHEN is_capped THEN CAST(full_size AS DOUBLE) ELSE (wanted - capped_size) / open_weight * weight END AS target FROM opened),
parts AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS ratio FROM targets),
quotas AS (
  SELECT source, source_size, target, CAST(floor(ratio) AS BIGINT) AS whole, ratio - floor(ratio) AS part,
         CAST(floor(target - floor(ratio) * source_size) AS BIGINT) AS quota FROM parts),
odds AS (
  SELECT b.doc_id, b.source, b.size, q.source_size, q.target, q.whole, q.part, q.quota, (b.draw + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM base b JOIN quotas q ON b.source IS NOT DISTINCT FROM q.source),
ratios AS (SELECT *, CASE WHEN part > 0 THEN (u / (1 - u)) / (part / (1 - part)) END AS r FROM odds),
ranked AS (SELECT *, CAST(floor(r / (1 + r) * 281474976710656::DOUBLE) AS BIGINT) AS rank FROM ratios),
sorted AS (SELECT *, part > 0 AND size > target * 0.001::DOUBLE AS is_long FROM ranked),
sides AS (
  SELECT source, any_value(quota) AS quota, CAST(coalesce(sum(size) FILTER (WHERE NOT is_long), 0) AS BIGINT) AS short_words, any_value(part) AS part,
         CAST(coalesce(sum(size) FILTER (WHERE is_long), 0) AS BIGINT) AS long_words FROM sorted WHERE part > 0 GROUP BY source),
longs AS (
  SELECT source, rank, doc_id, size, words, upto, all_words - upto AS after, row_number() OVER (PARTITION BY source ORDER BY bits DESC, rank, doc_id NULLS FIRST, size) AS k
  FROM (SELECT *, CAST(sum(words) OVER (PARTITION BY source ORDER BY bits DESC) AS BIGINT) AS upto, CAST(sum(words) OVER (PARTITION BY source) AS BIGINT) AS all_words
    FROM (SELECT source, rank, doc_id, size, length(format('{:b}', size)) AS bits, CAST(sum(size) AS BIGINT) AS words FROM sorted WHERE is_long GROUP BY ALL))),
limits AS (
  SELECT l.*, s.quota, greatest(least(CAST(floor(s.part * l.upto) AS BIGINT), s.quota), s.quota - s.short_words - l.after) AS most
  FROM longs l JOIN sides s ON l.source IS NOT DISTINCT FROM s.source),
fit AS (
  SELECT source, k, doc_id, size, CASE WHEN words <= 2 * most AND words <= quota THEN words ELSE 0 END AS total, words <= 2 * most AND words <= quota AS taken FROM limits WHERE k = 1
  UNION ALL SELECT l.source, l.k, l.doc_id, l.size, CASE WHEN l.words <= 2 * (most - f.total) AND f.total + l.words <= l.quota THEN f.total + l.words ELSE f.total END,
    l.words <= 2 * (most - f.total) AND f.total + l.words <= l.quota
  FROM fit f JOIN limits l ON l.source IS NOT DISTINCT FROM f.source AND l.k = f.k + 1),
chosen AS (SELECT source, doc_id, size FROM fit WHERE taken),
short_quota AS (
  SELECT s.source, s.quota - coalesce(f.total, 0) AS short_quota
  FROM sides s LEFT JOIN (SELECT source, max(total) AS total FROM fit GROUP BY source) f ON s.source IS NOT DISTINCT FROM f.source),
summed AS (
  SELECT s.*, q.short_quota, c.size IS NOT NULL AS is_chosen,
         sum(CASE WHEN s.part > 0 AND NOT is_long THEN s.size END) OVER (PARTITION BY s.source ORDER BY s.rank RANGE UNBOUNDED PRECEDING) AS upto
  FROM sorted s LEFT JOIN short_quota q ON s.source IS NOT DISTINCT FROM q.source
  LEFT JOIN chosen c ON is_long AND s.source IS NOT DISTINCT FROM c.source AND s.doc_id IS NOT DISTINCT FROM c.doc_id AND s.size = c.size),
inside AS (SELECT *, coalesce(CASE WHEN part > 0 THEN CASE WHEN is_long THEN is_chosen ELSE upto <= short_quota END END, false) AS is_in FROM summed),
gaps AS (SELECT *, short_quota - coalesce(sum(CASE WHEN is_in AND NOT is_long THEN size END) OVER (PARTITION BY source), 0) AS gap FROM inside),
closing AS (
  SELECT source, doc_id, size FROM (
    SELECT source, doc_id, size, row_number() OVER (PARTITION BY source ORDER BY abs(size - gap), rank, doc_id, size) AS k
    FROM gaps WHERE part > 0 AND NOT is_in AND abs(size - gap) < gap) WHERE k = 1)
SELECT g.doc_id, g.size, g.source_size, g.target,
       CAST((g.whole + CASE WHEN g.is_in OR (g.part > 0 AND c.size IS NOT NULL) THEN 1 ELSE 0 END) * g.size AS BIGINT) AS taken
FROM gaps g LEFT JOIN closing c ON g.source IS NOT DISTINCT FROM c.source AND g.doc_id IS NOT DISTINCT FROM c.doc_id AND g.size = c.size
""")
def _mix(t: Tables) -> DataFrame:
    return mixing.mix_sources(t.documents).select("doc_id", "size", "source_size", "target", "taken")


@query("op10_decontaminate", r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + 12], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM wins),
found AS (
  SELECT doc_id, i, n, item_id
  FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)) JOIN wins USING (n, win)),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM found GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN named USING (doc_id)
""")
def _decontaminate(t: Tables) -> DataFrame:
    found = decontaminate.find_contamination(t.documents, t.benchmark)
    digest = F.sha2(F.array_join("item_ids", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


@query("op2_near_embeddings", r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT a AS node, b AS other FROM pairs UNION SELECT r.node, p.b FROM reach r JOIN pairs p ON r.other = p.a),
comp AS (SELECT node, min(other) AS low FROM reach GROUP BY node),
deg AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT e.vec_id, CAST(coalesce(d.n, 0) AS BIGINT) AS n_links, least(e.vec_id, coalesce(c.low, e.vec_id)) AS component_id,
       e.vec_id <= coalesce(c.low, e.vec_id) AS kept
FROM embeddings e LEFT JOIN deg d ON e.vec_id = d.a LEFT JOIN comp c ON e.vec_id = c.node
""")
def _near_embeddings(t: Tables) -> DataFrame:
    return embeddings.near_embeddings(t.embeddings)


@query("op7_minhash_near_dedup", r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
pairs AS (SELECT a, b FROM both_ JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (SELECT a AS node, b AS other FROM pairs UNION SELECT r.node, p.b FROM reach r JOIN pairs p ON r.other = p.a),
comp AS (SELECT node, min(other) AS low FROM reach GROUP BY node)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(low, d.doc_id) AS kept
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN comp ON d.doc_id = comp.node
""")
def _near_duplicates(t: Tables) -> DataFrame:
    return minhash.near_duplicates(t.documents, shingle=3, similarity=0.85)


@query("op6_quality_resample")
def _quality(t: Tables) -> DataFrame:
    return quality.importance_resample(t.documents, t.labels)


@query("op3_toxicity_cnn")
def _toxicity(t: Tables) -> DataFrame:
    return toxicity.score_toxicity(t.documents, t.labels)


@query("op9_balanced_shards")
def _shards(t: Tables) -> DataFrame:
    return sharding.shard_documents(t.documents)


@query("op4_warc_normalise")
def _warc(t: Tables) -> DataFrame:
    return warc.archive_pages(t.pages).drop("archive")


@query("op5_token_planes")
def _planes(t: Tables) -> DataFrame:
    import public_tokenizers

    return planes.write_token_planes(t.documents, public_tokenizers.path("word_bpe_49k.json")).drop("file")


@query("op8_pii_semi_markov")
def _pii(t: Tables) -> DataFrame:
    found = pii.find_pii(t.documents)
    # a second parameter of the lambda would be the element's place
    of = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    counts = [of(k).alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.joined("base"), 256).alias("base_sha256"), pii.joined("spans").alias("spans"))


@query("op11_source_divergence", r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT id, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS whole FROM t GROUP BY ALL HAVING count(DISTINCT id) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(whole) AS n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
cells AS (SELECT t.lang, t.source, term, count(*) AS times FROM t JOIN kept USING (lang, term) GROUP BY ALL),
every AS (SELECT lang, source, term, whole, coalesce(times, 0) AS times FROM groups JOIN kept USING (lang) LEFT JOIN cells USING (lang, source, term)),
sums AS (SELECT lang, source, sum(times) AS n FROM every GROUP BY ALL),
shares AS (
  SELECT e.lang, e.source, term, times, CAST(1 + 1000000000::HUGEINT * (times + 2) // (s.n + 2 * v) AS BIGINT) AS p,
         CAST(1 + 1000000000::HUGEINT * (whole + 2) // (l.n + 2 * v) AS BIGINT) AS q
  FROM every e JOIN sums s ON e.lang = s.lang AND e.source = s.source JOIN langs l ON e.lang = l.lang),
apart AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS BIGINT) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE times > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item COLLATE C) AS INTEGER) AS rank FROM parts)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
""")
def _divergence(t: Tables) -> DataFrame:
    return divergence.source_divergence(t.documents)


@query("op12_prefix_bpe")
def _prefix_bpe(t: Tables) -> DataFrame:
    import public_tokenizers

    return prefix_bpe.encode_and_decode(t.documents, public_tokenizers.path("byte_bpe_50k.json"))


@query("op13_conversation_trie", r"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn,
         sha256(concat(CAST(octet_length(encode(coalesce(role, ''))) AS VARCHAR), ':', coalesce(role, ''), coalesce(text, ''))) AS mark
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(struct_pack(mark := mark, bytes := octet_length(encode(text))) ORDER BY turn NULLS FIRST, mark) AS w FROM turns GROUP BY conv_id),
crcs AS (
  SELECT conv_id, w, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(CAST(conv_id AS VARCHAR)) + 1), lambda i: CAST(ascii(CAST(conv_id AS VARCHAR)[i]) AS BIGINT))),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), list_transform(range(0, 8), lambda k: k)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::BIGINT) ELSE c // 2 END)) AS crc FROM own),
hs AS (SELECT conv_id, w, CAST(xor(crc, 4294967295::BIGINT) % 9 AS BIGINT) AS h FROM crcs),
built AS (SELECT c.conv_id, list_concat(coalesce(b.w, [])[1:c.h], c.w[c.h + 1:]) AS w FROM hs c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 5),
paths AS (SELECT conv_id, d AS depth, array_to_string(list_transform(w[1:d], lambda x: x.mark), ',') AS node, CASE WHEN d > 0 THEN w[d].bytes ELSE 0 END AS bytes, len(w) = d AS is_end
          FROM (SELECT conv_id, w, unnest(range(0, len(w) + 1)) AS d FROM built)),
nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
         sha256(coalesce(string_agg(CASE WHEN is_end THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256 FROM paths GROUP BY node, depth),
above AS (SELECT n.node, n.depth, p.node AS up, p.depth AS up_depth FROM nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.depth <= n.depth),
kids AS (SELECT up AS node, up_depth AS depth, count(*) AS n FROM above WHERE up_depth = depth - 1 GROUP BY ALL),
sums AS (
  SELECT a.up AS node, a.up_depth AS depth, sum(CASE WHEN k.n IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((n.n_convs - 1) * n.bytes) AS saved
  FROM above a JOIN nodes n ON n.node = a.node AND n.depth = a.depth LEFT JOIN kids k ON k.node = a.node AND k.depth = a.depth GROUP BY ALL)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, CAST(coalesce(k.n, 0) AS BIGINT) AS n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.node = n.node AND s.depth = n.depth LEFT JOIN kids k ON k.node = n.node AND k.depth = n.depth
LEFT JOIN above a ON a.node = n.node AND a.depth = n.depth AND a.up_depth = n.depth - 1 LEFT JOIN nodes p ON p.node = a.up AND p.depth = a.up_depth
""")
def _trie(t: Tables) -> DataFrame:
    return trie.conversation_trie(t.conversations)
