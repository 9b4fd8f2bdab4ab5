"""Documents, conversations and vectors as named queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import text as X
from ..operators import vectors as V
from .catalog import query
from .core_queries import _SHARE, r


@query("html_to_text", """
    SELECT page_id, regexp_extract(html, '<title>(.*?)</title>', 1, 's') AS title, html LIKE '%<article%' AS has_text FROM pages""")
def _(t):
    return X.html_to_text(t.pages).select("page_id", "title", F.col("text").isNotNull().alias("has_text"))


@query("chunk_by_heading")
def _(t):
    docs = t.documents.select(F.col("doc_id").alias("id"), "text")
    pages = X.html_to_text(t.pages).select(F.col("page_id").alias("id"), "text")
    return X.chunk_by_heading(docs.unionByName(pages), "text", 100, 10, 20)


_WORDS = "list_filter(regexp_split_to_array(coalesce({c}, ''), '\\s+'), lambda w: w <> '')"


@query("chunk_fixed", f"""
    SELECT doc_id, CAST(k AS BIGINT) AS chunk_no, array_to_string(w[k * 90 + 1 : k * 90 + 100], ' ') AS chunk FROM (
      SELECT doc_id, w, unnest(range(CAST(greatest(ceil((len(w) - 100) / 90.0), 0) AS BIGINT) + 1)) AS k
      FROM (SELECT doc_id, {_WORDS.format(c='text')} AS w FROM documents WHERE text IS NOT NULL))""")
def _(t):
    chunks = X.chunk_fixed(t.documents.select("doc_id", "text"), "text", 100, 10)
    return chunks.filter("status = 'ok'").select("doc_id", F.col("chunk_no").cast("bigint").alias("chunk_no"), "chunk")


_MARKED = """string_split(regexp_replace(regexp_replace(regexp_replace(text, '([.!?]["'')\\]]?)\\s+', '\\1' || chr(31), 'g'),
    '\\b(Mr|Mrs|Ms|Dr|Prof|St|vs|etc|e\\.g|i\\.e|No|Fig|approx|bzw|z\\.B|Sr|Sra)\\.' || chr(31), '\\1. ', 'g'), '([。！？])', '\\1' || chr(31), 'g'), chr(31))"""


@query("chunk_sentences", f"""
    WITH RECURSIVE s AS (SELECT doc_id, k, list_filter(string_split_regex(p, '\\s+'), lambda x: x <> '') AS w FROM (
        SELECT doc_id, unnest(parts) AS p, generate_subscripts(parts, 1) AS k FROM (SELECT doc_id, {_MARKED} AS parts FROM documents WHERE text IS NOT NULL))),
    pieces AS (SELECT doc_id, k, j, w[j * 120 + 1 : j * 120 + 120] AS w FROM (SELECT *, unnest(range((len(w) + 119) // 120)) AS j FROM s)),
    units AS (SELECT doc_id, list(w ORDER BY k, j) AS us FROM pieces GROUP BY 1),
    fold(doc_id, us, i, since, total, prev, closed_from, closed_to) AS (
      SELECT doc_id, us, 0, 0, 0, 0, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT) FROM units
      UNION ALL SELECT doc_id, us, i + 1,
        CASE WHEN total = 0 OR total + len(us[i + 1]) <= 120 THEN since WHEN prev + len(us[i + 1]) <= 120 THEN i - 1 ELSE i END,
        CASE WHEN total = 0 OR total + len(us[i + 1]) <= 120 THEN total + len(us[i + 1]) WHEN prev + len(us[i + 1]) <= 120 THEN prev + len(us[i + 1]) ELSE len(us[i + 1]) END,
        len(us[i + 1]),
        CASE WHEN total > 0 AND total + len(us[i + 1]) > 120 THEN since END, CASE WHEN total > 0 AND total + len(us[i + 1]) > 120 THEN i - 1 END
      FROM fold WHERE i < len(us)),
    spans AS (SELECT doc_id, us, closed_from AS a, closed_to AS z FROM fold WHERE closed_to IS NOT NULL
              UNION ALL SELECT doc_id, us, since, i - 1 FROM fold WHERE i = len(us))
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY z) - 1 AS chunk_no, array_to_string(flatten(us[a + 1 : z + 1]), ' ') AS chunk, 'ok' AS status FROM spans
    UNION ALL SELECT doc_id, 0, NULL, 'error' FROM documents d WHERE doc_id NOT IN (SELECT doc_id FROM units)""")
def _(t):
    chunks = X.chunk_sentences(t.documents.select("doc_id", "text"), "text", 120)
    return chunks.withColumn("chunk_no", F.col("chunk_no").cast("bigint"))


@query("truncate_tokens", r"""
    SELECT doc_id, array_to_string(string_split(regexp_replace(text, '\n\s*\n+', chr(10) || chr(10), 'g'), ' ')[1:50], ' ') AS text FROM documents""")
def _(t):
    return X.truncate_tokens(t.documents.select("doc_id", "text"), "text", 50)


@query("embed")
def _(t):
    e = X.embed(t.documents.select("doc_id", "text"), "text", 64)
    return e.select("doc_id", F.size("embedding").alias("dim"), r(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x), 3).alias("norm"))


_CENTRES = """
    c AS (SELECT label, list(m ORDER BY i) AS centre FROM (SELECT label, i, avg(x) AS m FROM (
      SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY 1, 2) GROUP BY 1)"""


def _centres(t):
    """One query vector per label: its mean vector."""
    dim = t.embeddings.select(F.size("embedding").alias("d")).limit(1).first().d
    mean = F.array(*[F.avg(F.get("embedding", F.lit(i)).cast("double")) for i in range(dim)])
    return t.embeddings.groupBy("label").agg(mean.alias("embedding"))


@query("vector_top_k", f"""
    WITH {_CENTRES} SELECT label, vec_id, round(score, 6) AS score, rank FROM (
      SELECT c.label, vec_id, list_cosine_similarity(centre, embedding::DOUBLE[]) AS score,
        row_number() OVER (PARTITION BY c.label ORDER BY list_cosine_similarity(centre, embedding::DOUBLE[]) DESC, vec_id) AS rank FROM c, embeddings)
    WHERE rank <= 10""")
def _(t):
    out = V.vector_top_k(_centres(t), t.embeddings.select("vec_id", "embedding"), "label", "vec_id", "embedding", 10)
    return out.select("label", "vec_id", r("score").alias("score"), F.col("rank").cast("bigint").alias("rank"))


@query("vector_top_k_l2", f"""
    WITH {_CENTRES} SELECT label, vec_id, round(-d, 5) AS score FROM (
      SELECT c.label, vec_id, list_distance(centre, embedding::DOUBLE[]) AS d,
        row_number() OVER (PARTITION BY c.label ORDER BY list_distance(centre, embedding::DOUBLE[]), vec_id) AS rank FROM c, embeddings) WHERE rank <= 5""")
def _(t):
    out = V.vector_top_k(_centres(t), t.embeddings.select("vec_id", "embedding"), "label", "vec_id", "embedding", 5, "l2")
    return out.select("label", "vec_id", r("score", 5).alias("score"))


def _asked(t):
    """Every twentieth vector is a query, against all rows."""
    return t.embeddings.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


@query("vector_near")
def _(t):
    found = V.vector_near(_asked(t), t.embeddings.select("vec_id", "embedding"), "query_id", "vec_id", "embedding", k=10, cells=16, probes=12)
    return found.select("query_id", "vec_id", "score", F.col("rank").cast("bigint").alias("rank"))


_BRUTE = """
    SELECT query_id, vec_id, round(-d, 5) AS score FROM (
      SELECT q.vec_id AS query_id, e.vec_id, list_distance(q.embedding::DOUBLE[], e.embedding::DOUBLE[]) AS d,
        row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.embedding::DOUBLE[], e.embedding::DOUBLE[]), e.vec_id) AS rank
      FROM embeddings q, embeddings e WHERE q.vec_id % 20 = 0) WHERE rank <= 10"""


@query("vector_index_exact", _BRUTE)
def _(t):
    found = V.vector_near(_asked(t), t.embeddings.select("vec_id", "embedding"), "query_id", "vec_id", "embedding", k=10, cells=16, probes=4, exact=True)
    return found.select("query_id", "vec_id", r("score", 5).alias("score"))


@query("vector_index_recall", f"""
    WITH brute AS ({_BRUTE}) SELECT count(DISTINCT query_id) AS queries, count(*) AS neighbours, true AS recall_at_least_90_percent FROM brute""")
def _(t):
    base = t.embeddings.select("vec_id", "embedding")
    index = V.build_vector_index(base, "vec_id", "embedding", cells=16)
    want = index.search(_asked(t), "query_id", "embedding", 10, probes=4, exact=True).select("query_id", "vec_id")
    got = index.search(_asked(t), "query_id", "embedding", 10, probes=12).select("query_id", "vec_id", F.lit(1).alias("hit"))
    both = want.join(got, ["query_id", "vec_id"], "left")
    return both.agg(F.count_distinct("query_id").alias("queries"), F.count(F.lit(1)).alias("neighbours"),
                    (F.count("hit") >= 0.9 * F.count(F.lit(1))).alias("recall_at_least_90_percent"))


_PAIRS = """
    pairs AS (SELECT u.conv_id, u.turn, u.text AS question, a.text AS answer FROM conversations u JOIN conversations a
      ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant')"""
_TOKENS = "list_distinct(list_filter(regexp_split_to_array(lower({c}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> ''))"


def _pairs(t):
    """User turns with the assistant turn right after them."""
    c = t.conversations
    u = c.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"))
    a = c.filter("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    return u.join(a, ["conv_id", "turn"])


@query("text_similarity", f"""
    WITH {_PAIRS}, k AS (SELECT *, {_TOKENS.format(c='question')} AS q, {_TOKENS.format(c='answer')} AS a FROM pairs)
    SELECT conv_id, turn, round(len(list_intersect(q, a)) / nullif(len(list_distinct(list_concat(q, a))), 0)::DOUBLE, 6) AS jaccard,
      round(1 - levenshtein(x, y) / greatest(length(x), length(y))::DOUBLE, 6) AS edit
    FROM (SELECT *, regexp_replace(lower(question), '[^a-z ]', '', 'g') AS x, regexp_replace(lower(answer), '[^a-z ]', '', 'g') AS y FROM k)""")
def _(t):
    plain = {c: F.regexp_replace(F.lower(s), "[^a-z ]", "") for c, s in (("x", "question"), ("y", "answer"))}
    return _pairs(t).withColumns(plain).select(
        "conv_id", "turn", r(X.text_similarity("question", "answer")).alias("jaccard"),
        r(X.text_similarity("x", "y", "levenshtein")).alias("edit"))


_LANGS = {"english": ["the", "and", "of", "that"], "german": ["der", "und", "die", "das"],
          "french": ["le", "de", "et", "la"], "spanish": ["que", "el", "en", "los"]}


_TERMS = r"list_filter(regexp_split_to_array(lower(coalesce({c}, '')), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"
_IDF = f"""idf AS (SELECT term, ln((1 + (SELECT count(*) FROM conversations)) / (1.0 + count(*))) + 1 AS idf FROM (
    SELECT unnest(list_distinct({_TERMS.format(c='text')})) AS term FROM conversations) GROUP BY 1)"""


@query("text_cosine", f"""
    WITH {_PAIRS}, {_IDF},
    w AS (SELECT conv_id, turn, side, term, count(*) * any_value(idf) AS w FROM (
        SELECT conv_id, turn, 'q' AS side, unnest({_TERMS.format(c='question')}) AS term FROM pairs
        UNION ALL SELECT conv_id, turn, 'a', unnest({_TERMS.format(c='answer')}) FROM pairs) JOIN idf USING (term) GROUP BY ALL),
    n AS (SELECT conv_id, turn, sqrt(sum(w * w) FILTER (side = 'q')) * sqrt(sum(w * w) FILTER (side = 'a')) AS n FROM w GROUP BY 1, 2),
    d AS (SELECT q.conv_id, q.turn, sum(q.w * a.w) AS d FROM w q JOIN w a USING (conv_id, turn, term) WHERE q.side = 'q' AND a.side = 'a' GROUP BY 1, 2)
    SELECT conv_id, turn, round(CASE WHEN n > 0 THEN coalesce(d, 0) / n END, 6) AS cosine FROM pairs LEFT JOIN n USING (conv_id, turn) LEFT JOIN d USING (conv_id, turn)""")
def _(t):
    idf = X.inverse_frequencies(t.conversations, "text")
    return X.text_cosine(_pairs(t), ["conv_id", "turn"], "question", "answer", idf).select("conv_id", "turn", r("cosine").alias("cosine"))


@query("nearest_label", f"""
    WITH {_PAIRS}, {_IDF}, l AS (SELECT label, term, count(*) * any_value(idf) AS w FROM (
        SELECT label, unnest({_TERMS.format(c='description')}) AS term FROM (VALUES {', '.join(f"('{k}', '{' '.join(v)}')" for k, v in _LANGS.items())}) v(label, description)) JOIN idf USING (term) GROUP BY 1, 2),
    u AS (SELECT label, term, w / sqrt(sum(w * w) OVER (PARTITION BY label)) AS w FROM l),
    q AS (SELECT conv_id, turn, term, count(*) * any_value(idf) AS w FROM (SELECT conv_id, turn, unnest({_TERMS.format(c='question')}) AS term FROM pairs) JOIN idf USING (term) GROUP BY ALL),
    s AS (SELECT conv_id, turn, label, round(sum(q.w * u.w), 9) AS s FROM q JOIN u USING (term) GROUP BY ALL),
    b AS (SELECT conv_id, turn, label FROM s QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY s DESC, label) = 1)
    SELECT conv_id, turn, coalesce(label, 'other') AS label FROM pairs LEFT JOIN b USING (conv_id, turn)""")
def _(t):
    labels = t.spark.createDataFrame([(k, " ".join(v)) for k, v in _LANGS.items()], "label string, description string")
    idf = X.inverse_frequencies(t.conversations, "text")
    return X.nearest_label(_pairs(t), ["conv_id", "turn"], "question", labels, idf).select("conv_id", "turn", "label")


def _hits_sql(keys):
    return "len(list_filter(w, lambda x: x IN (" + ", ".join(f"'{k}'" for k in keys) + ")))"


_HITS = ", ".join(f"{_hits_sql(keys)} AS h{i}" for i, keys in enumerate(_LANGS.values()))
_BEST = "CASE WHEN greatest(h0, h1, h2, h3) = 0 THEN 'other' " + " ".join(
    f"WHEN h{i} = greatest(h0, h1, h2, h3) THEN '{name}'" for i, name in enumerate(_LANGS)) + " END"


@query("classify_text", f"""
    SELECT doc_id, {_BEST} AS category FROM (SELECT doc_id, {_HITS} FROM (
      SELECT doc_id, regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+') AS w FROM documents))""")
def _(t):
    return X.classify_text(t.documents.select("doc_id", "text"), "text", _LANGS).select("doc_id", "category")


@query("flag_text", f"""
    SELECT doc_id, CASE WHEN p > n THEN 'positive' WHEN p < n THEN 'negative' ELSE 'neutral' END AS sentiment, p < n AS needs_follow_up FROM (
      SELECT doc_id, {_hits_sql(['the', 'of'])} AS p, {_hits_sql(['and', 'for'])} AS n FROM (
        SELECT doc_id, regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+') AS w FROM documents))""")
def _(t):
    return X.flag_text(t.documents.select("doc_id", "text"), "text", ["the", "of"], ["and", "for"]).drop("text")


@query("build_chat", f"""
    WITH {_PAIRS} SELECT conv_id, turn, to_json([{{role: 'system', content: 'Answer briefly.'}}, {{role: 'user', content: question}},
      {{role: 'assistant', content: answer}}])::VARCHAR AS messages, to_json([{{role: 'system', content: 'Answer briefly.'}},
      {{role: 'user', content: question}}])::VARCHAR AS prompt FROM pairs""")
def _(t):
    chat = X.build_chat(_pairs(t), F.lit("Answer briefly."), "question", "answer")
    prompt = X.drop_last_message(chat.withColumn("prompt", F.col("messages")), "prompt")
    return prompt.select("conv_id", "turn", F.to_json("messages").alias("messages"), F.to_json("prompt").alias("prompt"))


@query("build_prompt", """
    SELECT p_partkey, 'Describe ' || p_name || ' of brand ' || p_brand || '. Facts: {"p_type":"' || p_type || '","p_size":' || p_size || '}' AS prompt FROM part""")
def _(t):
    return X.build_prompt(t.part, "Describe {p_name} of brand {p_brand}. Facts: {json}", ["p_type", "p_size"]).select("p_partkey", "prompt")


@query("concat_capped", """
    SELECT lang, substr(string_agg(text, ' | ' ORDER BY doc_id), 1, 5000) AS joined FROM documents GROUP BY 1""")
def _(t):
    d = t.documents.select("doc_id", "lang", "text")
    return X.concat_capped(d, ["lang"], ["doc_id"], F.col("doc_id"), "text", 5000, " | ")


@query("qa_dataset", """
    SELECT doc_id, question, answer, n_chars FROM documents JOIN (
      SELECT doc_id, 'Is it good?' AS question, CASE WHEN quality = 1 THEN 'yes' ELSE 'no' END AS answer FROM labels
      UNION ALL SELECT doc_id, 'Is it toxic?', CASE WHEN toxic = 1 THEN 'yes' ELSE 'no' END FROM labels) USING (doc_id)""")
def _(t):
    asked = t.labels.select("doc_id", F.array(F.lit("Is it good?"), F.lit("Is it toxic?")).alias("question"))
    yes = lambda c: F.when(F.col(c) == 1, "yes").otherwise("no")
    answers = t.labels.select("doc_id", F.lit("Is it good?").alias("question"), yes("quality").alias("answer")).unionByName(
        t.labels.select("doc_id", F.lit("Is it toxic?").alias("question"), yes("toxic").alias("answer")))
    return X.qa_dataset(t.documents.select("doc_id", "n_chars"), asked, answers, "doc_id", "question")


@query("extraction_scores", f"""
    WITH {_PAIRS}, k AS (SELECT conv_id, turn, {_TOKENS.format(c='question')} AS q, {_TOKENS.format(c='answer')} AS a FROM pairs)
    SELECT conv_id, turn, round(coalesce(len(list_intersect(q, a)) / nullif(len(a), 0)::DOUBLE, 0), 6) AS "precision",
      round(coalesce(len(list_intersect(q, a)) / nullif(len(q), 0)::DOUBLE, 0), 6) AS recall FROM k""")
def _(t):
    mixed = F.filter(F.split("answer", X.NOT_WORD), lambda w: w != "")
    lists = _pairs(t).select("conv_id", "turn", mixed.alias("predicted"), X.token_set("question").alias("truth"))
    return X.extraction_scores(lists, "predicted", "truth").select("conv_id", "turn", r("precision").alias("precision"), r("recall").alias("recall"))


_FEEDBACK = f"""
    {_PAIRS}, req AS (SELECT conv_id * 1000 + turn AS request_id, question AS request, answer AS response FROM pairs),
    ass AS (SELECT request_id, request_id % 3 AS user_id, 10 AS stamp, CASE request_id % 4 WHEN 0 THEN 'positive' WHEN 1 THEN 'negative' ELSE 'unsure' END AS rating,
        CASE WHEN request_id % 8 = 1 THEN 'better' ELSE '' END AS suggestion FROM req
      UNION ALL SELECT request_id, request_id % 3, 20, 'negative', 'fixed' FROM req WHERE request_id % 5 = 0)"""


@query("feedback_dataset", f"""
    WITH {_FEEDBACK}, latest AS (SELECT * FROM ass QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY stamp DESC) = 1)
    SELECT request_id, request, CASE WHEN rating = 'positive' THEN response ELSE nullif(suggestion, '') END AS expected_response,
      CASE rating WHEN 'positive' THEN 'thumbs_up' WHEN 'negative' THEN 'thumbs_down' ELSE 'no_feedback_provided' END AS type, user_id,
      CASE WHEN request_id % 2 = 0 THEN 'chunk a,chunk b' END AS notes FROM latest JOIN req USING (request_id)""")
def _(t):
    rid = F.col("request_id")
    req = _pairs(t).select((F.col("conv_id") * 1000 + F.col("turn")).alias("request_id"), F.col("question").alias("request"), F.col("answer").alias("response"))
    rating = F.when(rid % 4 == 0, "positive").when(rid % 4 == 1, "negative").otherwise("unsure")
    base = req.select("request_id", (rid % 3).alias("user_id"))
    none = F.lit(None).cast("string")
    first = base.select("*", F.lit(10).alias("timestamp"), rating.alias("rating"),
                        F.when(rid % 8 == 1, "better").otherwise("").alias("suggested_output"), none.alias("retrieval"))
    later = base.filter(rid % 5 == 0).select("*", F.lit(20).alias("timestamp"), F.lit("negative").alias("rating"),
                                             F.lit("fixed").alias("suggested_output"), none.alias("retrieval"))
    notes = base.filter(rid % 2 == 0).select("*", F.lit(15).alias("timestamp"), none.alias("rating"), none.alias("suggested_output"),
                                             F.explode(F.array(F.lit("chunk b"), F.lit("chunk a"))).alias("retrieval"))
    out = X.feedback_dataset(req, first.unionByName(later).unionByName(notes))
    return out.select("request_id", "request", "expected_response", "type", "user_id", F.array_join("retrieval_notes", ",").alias("notes"))


@query("eval_queue", f"""
    WITH {_PAIRS}, req AS (SELECT conv_id * 1000 + turn AS request_id FROM pairs)
    SELECT request_id, CASE WHEN {_SHARE.format(k='request_id')} < 0.3 OR request_id % 7 = 0 THEN 'todo' ELSE 'skipped' END AS eval_status FROM req""")
def _(t):
    req = _pairs(t).select((F.col("conv_id") * 1000 + F.col("turn")).alias("request_id"))
    queue = X.eval_queue(None, req.filter("request_id % 2 = 0"), "request_id", 0.3)
    return X.eval_queue(queue, req, "request_id", 0.3, feedback=req.filter("request_id % 7 = 0"))


@query("quality_daily", """
    SELECT DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS day, lang, count(*) AS n, count(DISTINCT source) AS sessions,
      round(avg(quality), 6) AS relevance, round(avg(toxic), 6) AS toxicity FROM labels JOIN documents USING (doc_id) GROUP BY 1, 2""", dates=("day",))
def _(t):
    d = t.labels.join(t.documents.select("doc_id", "lang", "source"), "doc_id").withColumn(
        "day_ts", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int")))
    out = X.quality_daily(d, "day_ts", "lang", "source", "quality", "toxic")
    return out.withColumns({"relevance": r("relevance"), "toxicity": r("toxicity")})
