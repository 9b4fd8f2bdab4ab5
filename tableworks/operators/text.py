"""Documents, conversations and evaluation sets.

Python runs only where Spark has no expression for it (HTML, heading-aware
chunks), in Arrow batches; everything else stays in the JVM.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .blocks import running
from .clean import hash_share

# everything but letters and digits of any script
NOT_WORD = r"[^\p{L}\p{N}]+"


# ---- pages ----------------------------------------------------------------

class _Article(HTMLParser):
    """Text of the ``article`` element; headings get ``#`` marks, blocks end a line."""

    blocks = {"p", "div", "li", "ul", "ol", "table", "tr", "br", "section", "blockquote", "pre"}
    silent = {"script", "style", "noscript"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth = 0
        self.hidden = 0
        self.found = False
        self.parts: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag == "article":
            self.depth += 1
            self.found = True
        elif tag in self.silent:
            self.hidden += 1
        elif self.depth and len(tag) == 2 and tag[0] == "h" and tag[1].isdigit():
            self.parts.append("\n\n" + "#" * int(tag[1]) + " ")
        elif self.depth and tag in self.blocks:
            self.parts.append("\n")

    def handle_endtag(self, tag):
        if tag == "article" and self.depth:
            self.depth -= 1
        elif tag in self.silent and self.hidden:
            self.hidden -= 1
        elif self.depth and (tag in self.blocks or (len(tag) == 2 and tag[0] == "h" and tag[1].isdigit())):
            self.parts.append("\n")

    def handle_data(self, data):
        if self.depth and not self.hidden:
            self.parts.append(_without_inline_data(data) if "data:" in data else data)


def _without_inline_data(data: str) -> str:
    """Text without the words that hold an inline ``data:`` address; its scheme, type and comma tell it from a word."""
    return "".join(w for w in re.split(r"(\s+)", data) if not _INLINE.search(w))


_INLINE = re.compile(r"(?<![A-Za-z0-9])data:[^,]*,")


def article_text(html: str | None) -> str | None:
    """Body text of one page; None without an article or when parsing fails."""
    if not html:
        return None
    parser = _Article()
    try:
        parser.feed(html)
        parser.close()
    except (AssertionError, ValueError):
        return None
    if not parser.found:
        return None
    text = "".join(parser.parts)
    lines = [re.sub(r"[ \t]+", " ", line).strip() for line in text.split("\n")]
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip()


def html_to_text(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """Article body and title of every page; a page without an article keeps a null text."""

    @F.pandas_udf("string")
    def body(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pages.map(article_text)

    return pages.withColumns({out: body(html), "title": F.regexp_extract(html, "(?s)<title>(.*?)</title>", 1)})


# ---- chunks ---------------------------------------------------------------

def words(text: str) -> int:
    """Token count used for chunk sizes: whitespace-separated words."""
    return len(text.split())


def split_text(text: str, size: int, overlap: int, count: Callable[[str], int] = words) -> list[str]:
    """Pieces of at most ``size`` tokens, cut at paragraphs, else lines, else words.

    A piece begins with the last units of the one before, up to ``overlap``
    tokens.
    """
    def units(part: str, marks: Sequence[str]) -> Iterator[str]:
        if count(part) <= size or not marks:
            if part.strip():
                yield part
            return
        bits = part.split(marks[0])
        for i, bit in enumerate(bits):
            yield from units(bit + (marks[0] if i < len(bits) - 1 else ""), marks[1:])

    chunks: list[str] = []
    current: list[tuple[str, int]] = []
    total = 0
    for unit in units(text, ["\n\n", "\n", " "]):
        n = count(unit)
        if current and total + n > size:
            chunks.append("".join(u for u, _ in current).strip())
            kept: list[tuple[str, int]] = []
            carried = 0
            for u, k in reversed(current):
                if carried + k > overlap or carried + k + n > size:
                    break
                kept.insert(0, (u, k))
                carried += k
            current, total = kept, carried
        current.append((unit, n))
        total += n
    if current:
        chunks.append("".join(u for u, _ in current).strip())
    return chunks


def chunk_by_heading(df: DataFrame, text: str, max_tokens: int = 500, min_tokens: int = 20, overlap: int = 50,
                     out: str = "chunk", position: str = "chunk_no", heading: str = "## ") -> DataFrame:
    """One row per heading-aware chunk, without Python.

    A text is cut before each line that begins with ``heading``. Sections are
    packed in order: one joins the chunk before it while both together have at
    most ``max_tokens`` words. A longer chunk becomes windows of ``max_tokens``
    words that overlap by ``overlap``. Chunks below ``min_tokens`` words go.
    """
    words_of = lambda t: F.filter(F.split(t, r"\s+"), lambda w: w != "")
    sections = F.transform(F.split(F.coalesce(F.col(text), F.lit("")), f"(?m)(?=^{re.escape(heading)})"), words_of)
    sections = F.filter(sections, lambda w: F.size(w) > 0)

    cut = df.withColumn("_sections", sections)
    packed = F.transform(_packed_spans("_sections", max_tokens, repeat_last=False), lambda x: _units_of("_sections", x))
    step = max_tokens - overlap
    starts = lambda w: F.sequence(F.lit(0), F.greatest(F.ceil((F.size(w) - max_tokens) / F.lit(float(step))), F.lit(0)).cast("int"))
    pieces = F.flatten(F.transform(packed, lambda w: F.transform(starts(w), lambda i: F.slice(w, i * step + 1, max_tokens))))
    chunks = F.transform(F.filter(pieces, lambda w: F.size(w) >= min_tokens), lambda w: F.array_join(w, " "))
    rest = [F.col(c) for c in df.columns if c != text]
    return cut.select(*rest, F.posexplode(chunks).alias(position, out))


def _packed_spans(units: str, size: int, repeat_last: bool) -> Column:
    """First and last place of the runs that units (lists of words) are packed into, in order, up to ``size`` words each.

    The fold carries numbers only and appends where a run ends. With
    ``repeat_last`` a run begins with the last unit of the one before where
    that and the next one fit together.
    """
    counted = F.transform(units, lambda u, i: F.struct(F.size(u).alias("n"), i.alias("i")))
    zero = F.struct(F.lit(0).alias("at"), F.lit(0).alias("total"), F.lit(0).alias("last"),
                    F.array().cast("array<struct<first:int,final:int>>").alias("spans"))

    def span(first: Column, final: Column) -> Column:
        return F.array(F.struct(first.alias("first"), final.alias("final")))

    def step(s: Column, x: Column) -> Column:
        full = (s["total"] > 0) & (s["total"] + x["n"] > size)
        again = F.lit(repeat_last) & (s["last"] + x["n"] <= size)
        return F.struct(
            F.when(~full, s["at"]).when(again, x["i"] - 1).otherwise(x["i"]).alias("at"),
            F.when(~full, s["total"] + x["n"]).when(again, s["last"] + x["n"]).otherwise(x["n"]).alias("total"),
            x["n"].alias("last"),
            F.when(full, F.concat(s["spans"], span(s["at"], x["i"] - 1))).otherwise(s["spans"]).alias("spans"))

    spans = F.aggregate(counted, zero, step, lambda s: F.concat(s["spans"], span(s["at"], F.size(units) - 1)))
    return F.when(F.size(units) > 0, spans).otherwise(F.array().cast("array<struct<first:int,final:int>>"))


def _units_of(units: str, span: Column) -> Column:
    return F.flatten(F.slice(units, span["first"] + 1, span["final"] - span["first"] + 1))


# fixed values: words whose full stop does not end a sentence
ABBREVIATIONS = ("Mr", "Mrs", "Ms", "Dr", "Prof", "St", "vs", "etc", "e.g", "i.e", "No", "Fig", "approx", "bzw", "z.B", "Sr", "Sra")


def chunk_sentences(df: DataFrame, text: str, size: int = 500, out: str = "chunk", position: str = "chunk_no",
                    abbreviations: Sequence[str] = ABBREVIATIONS) -> DataFrame:
    """Chunks of whole sentences of at most ``size`` words, each beginning with the last sentence of the one before where it fits.

    A sentence ends after ``.``, ``!`` or ``?`` (a closing quote or bracket may
    follow) before white space, unless the word is an abbreviation, and after
    a CJK mark. A sentence longer than ``size`` is cut into pieces of ``size``
    words. White space within a chunk becomes one blank. A null text, or one
    without words, is one row with a null chunk and status ``error``.
    """
    short = "|".join(re.escape(a) for a in abbreviations)
    ends = r"(?<=[.!?]|[.!?][\"')\]])" + (rf"(?<!\b(?:{short})\.)" if short else "") + r"\s+|(?<=[。！？])\s*"
    words_of = lambda t: F.filter(F.split(t, r"\s+"), lambda w: w != "")
    pieces = lambda w: F.transform(
        F.sequence(F.lit(0), F.floor((F.size(w) - 1) / F.lit(size)).cast("int")), lambda i: F.slice(w, i * size + 1, size))
    sentences = F.filter(F.transform(F.split(F.coalesce(F.col(text), F.lit("")), ends), words_of), lambda w: F.size(w) > 0)
    cut = df.withColumn("_sentences", F.flatten(F.transform(sentences, pieces)))
    chunks = F.transform(_packed_spans("_sentences", size, repeat_last=True), lambda x: F.array_join(_units_of("_sentences", x), " "))
    rest = [F.col(c) for c in df.columns if c != text]
    found = cut.select(*rest, F.posexplode_outer(chunks).alias(position, out))
    return found.withColumn("status", F.when(F.col(out).isNull(), "error").otherwise("ok")).withColumn(position, F.coalesce(position, F.lit(0)))


def chunk_fixed(df: DataFrame, text: str, size: int = 500, overlap: int = 50, out: str = "chunk", position: str = "chunk_no") -> DataFrame:
    """Windows of ``size`` words that overlap by ``overlap``, without Python.

    Rows whose text is missing give one row with status ``error``.
    """
    step = size - overlap
    tokens = df.withColumn("_w", F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"\s+"), lambda w: w != ""))
    last = F.greatest(F.ceil((F.size("_w") - size) / F.lit(float(step))), F.lit(0)).cast("int")
    starts = F.sequence(F.lit(0), last)
    rest = [F.col(c) for c in df.columns if c != text]
    cut = tokens.select(*rest, "_w", F.col(text).isNull().alias("_bad"), F.explode(starts).alias(position))
    piece = F.array_join(F.slice("_w", F.col(position) * step + 1, size), " ")
    return cut.select(*rest, position, F.when(~F.col("_bad"), piece).alias(out),
                      F.when(F.col("_bad"), "error").otherwise("ok").alias("status"))


def truncate_tokens(df: DataFrame, text: str, n: int, out: str | None = None) -> DataFrame:
    """The first ``n`` words, after runs of blank lines are squeezed to one."""
    squeezed = F.regexp_replace(text, r"\n\s*\n+", "\n\n")
    parts = F.split(squeezed, " ", -1)
    return df.withColumn(out or text, F.array_join(F.slice(parts, 1, n), " "))


# ---- vectors from text ----------------------------------------------------

def embed(df: DataFrame, text: str, dim: int = 256, out: str = "embedding") -> DataFrame:
    """Normalised hashed bag of words as ``array<float>``: a stand-in for a served model."""
    tokens = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), NOT_WORD), lambda w: w != "")
    tf = HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=dim).transform(df.withColumn("_tokens", tokens))
    norm = Normalizer(inputCol="_tf", outputCol="_v", p=2.0).transform(tf)
    return norm.withColumn(out, vector_to_array("_v", "float32")).drop("_tokens", "_tf", "_v")


def embed_with(df: DataFrame, text: str, client: Callable[[list[str]], list[list[float]]], batch: int = 150, out: str = "embedding") -> DataFrame:
    """Vectors from a caller's batch function (a served model), ``batch`` texts per call."""
    from pyspark.sql import types as T

    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            vectors: list[list[float]] = []
            texts = pdf[text].tolist()
            for i in range(0, len(texts), batch):
                vectors += client(texts[i:i + batch])
            yield pdf.assign(**{out: vectors})

    return df.mapInPandas(run, schema)


# ---- comparing and labelling ----------------------------------------------

def token_set(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.array_distinct(F.filter(F.split(F.lower(c), NOT_WORD), lambda w: w != ""))


def text_similarity(a: str, b: str, kind: str = "jaccard") -> Column:
    """Jaccard of word sets, or 1 - edit distance / longer length (``levenshtein``)."""
    if kind == "jaccard":
        x, y = token_set(a), token_set(b)
        return F.try_divide(F.size(F.array_intersect(x, y)).cast("double"), F.size(F.array_union(x, y)))
    if kind == "levenshtein":
        return F.lit(1.0) - F.try_divide(F.levenshtein(a, b).cast("double"), F.greatest(F.length(a), F.length(b)))
    raise ValueError(f"unknown kind {kind!r}")


def inverse_frequencies(df: DataFrame, text: str) -> DataFrame:
    """``term`` and ``idf`` = ln((1 + rows) / (1 + rows with the term)) + 1 over all rows; map-side combined counts."""
    counted = df.select(F.explode(token_set(F.coalesce(F.col(text), F.lit("")))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("_df"))
    return counted.join(df.agg(F.count(F.lit(1)).alias("_n"))).select("term", (F.log((F.col("_n") + 1) / (F.col("_df") + 1)) + 1).alias("idf"))


def _weights(df: DataFrame, key: Sequence[str], text: str, idf: DataFrame) -> DataFrame:
    """Sparse vector of a text, a row per term: ``tf`` times ``idf`` as ``w``; words outside the table of frequencies have none."""
    terms = df.select(*key, F.explode(word_list(text)).alias("term")).filter("term <> ''")
    return terms.groupBy(*key, "term").agg(F.count(F.lit(1)).alias("_tf")).join(idf, "term").select(*key, "term", (F.col("_tf") * F.col("idf")).alias("w"))


def text_cosine(df: DataFrame, keys: Sequence[str], a: str, b: str, idf: DataFrame, out: str = "cosine") -> DataFrame:
    """Cosine of the weighted word vectors of two texts of a row, null where one has no weight.

    Both texts go through one exchange by key and term and one by key; nothing
    is paired. ``keys`` identify a row.
    """
    sides = df.select(*keys, F.lit("a").alias("_side"), F.col(a).alias("_t")).unionByName(df.select(*keys, F.lit("b").alias("_side"), F.col(b).alias("_t")))
    weights = _weights(sides, [*keys, "_side"], "_t", idf)
    both = weights.groupBy(*keys, "term").agg(*[F.coalesce(F.sum(F.when(F.col("_side") == s, F.col("w"))), F.lit(0.0)).alias(f"_{s}") for s in "ab"])
    dots = both.groupBy(*keys).agg(F.sum(F.col("_a") * F.col("_b")).alias("_ab"), F.sum(F.col("_a") ** 2).alias("_aa"), F.sum(F.col("_b") ** 2).alias("_bb"))
    scored = dots.select(*keys, F.try_divide("_ab", F.sqrt(F.col("_aa") * F.col("_bb"))).alias(out))
    return df.join(scored, list(keys), "left")


def nearest_label(df: DataFrame, keys: Sequence[str], text: str, labels: DataFrame, idf: DataFrame, default: str = "other",
                  out: str = "label") -> DataFrame:
    """The label whose ``description`` is nearest by cosine (ties: the smaller label), ``default`` where no word is shared.

    ``labels``: label, description. Texts and descriptions meet on their shared terms only.
    """
    named = _weights(labels, ["label"], "description", idf)
    lengths = named.groupBy("label").agg(F.sqrt(F.sum(F.col("w") ** 2)).alias("_len"))
    described = named.join(lengths, "label").select("term", "label", (F.col("w") / F.col("_len")).alias("_lw"))
    # the length of the text itself is the same for all its labels
    shared = _weights(df, list(keys), text, idf).join(described, "term").groupBy(*keys, "label").agg(F.round(F.sum(F.col("w") * F.col("_lw")), 9).alias("_s"))
    best = shared.groupBy(*keys).agg(F.min_by("label", F.struct(-F.col("_s"), "label")).alias(out))
    return df.join(best, list(keys), "left").withColumn(out, F.coalesce(out, F.lit(default)))


def word_list(text: str) -> Column:
    return F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), NOT_WORD)


def _hits(words: str, keywords: Sequence[str]) -> Column:
    wanted = [k.lower() for k in keywords]
    return F.size(F.filter(F.col(words), lambda w: w.isin(wanted)))


def classify_text(df: DataFrame, text: str, labels: Mapping[str, Sequence[str]], default: str = "other", out: str = "category") -> DataFrame:
    """The label with most keyword hits (ties: the earlier one), ``default`` without a hit.

    With one label this answers a yes/no question.
    """
    body = df.withColumn("_w", word_list(text))
    scored = F.array(*[
        F.struct(_hits("_w", keys).alias("n"), F.lit(-i).alias("order"), F.lit(name).alias("label"))
        for i, (name, keys) in enumerate(labels.items())
    ])
    body = body.withColumn("_b", F.array_max(scored))
    return body.withColumn(out, F.when(F.col("_b.n") > 0, F.col("_b.label")).otherwise(F.lit(default))).drop("_w", "_b")


def flag_text(df: DataFrame, text: str, positive: Sequence[str], negative: Sequence[str]) -> DataFrame:
    """Sentiment by keyword balance, and a follow-up flag for negative texts."""
    body = df.withColumn("_w", word_list(text))
    balance = _hits("_w", positive) - _hits("_w", negative)
    mood = F.when(balance > 0, "positive").when(balance < 0, "negative").otherwise("neutral")
    return body.withColumn("sentiment", mood).withColumn("needs_follow_up", F.col("sentiment") == "negative").drop("_w")


# ---- training messages and prompts ----------------------------------------

def build_chat(df: DataFrame, system: str | Column | None, user: str | Column, assistant: str | Column | None, out: str = "messages") -> DataFrame:
    """``array<struct<role, content>>`` per row; strings name columns."""
    turns = []
    for role, content in (("system", system), ("user", user), ("assistant", assistant)):
        if content is not None:
            c = F.col(content) if isinstance(content, str) else content
            turns.append(F.struct(F.lit(role).alias("role"), c.alias("content")))
    return df.withColumn(out, F.array(*turns))


def drop_last_message(df: DataFrame, messages: str = "messages") -> DataFrame:
    """Prompts: everything but the final answer."""
    return df.withColumn(messages, F.slice(messages, 1, F.greatest(F.size(messages) - 1, F.lit(0))))


def build_prompt(df: DataFrame, template: str, fields: Sequence[str], out: str = "prompt") -> DataFrame:
    """``{field}`` places filled by columns, ``{json}`` by all ``fields`` as JSON."""
    parts: list[Column] = []
    for bit in re.split(r"(\{\w+\})", template):
        if bit == "{json}":
            parts.append(F.to_json(F.struct(*fields)))
        elif bit.startswith("{") and bit.endswith("}"):
            parts.append(F.coalesce(F.col(bit[1:-1]).cast("string"), F.lit("")))
        elif bit:
            parts.append(F.lit(bit))
    return df.withColumn(out, F.concat(*parts))


def concat_capped(df: DataFrame, keys: Sequence[str], order: Sequence[str], along: Column, text: str, cap: int,
                  separator: str = " ", out: str = "joined") -> DataFrame:
    """Texts of a group joined in order, cut after ``cap`` characters.

    Lengths are summed first, without the texts: only rows that begin before the
    cap are then looked up, cut and collected, so a group never moves or gathers
    more than the result needs.
    """
    clean = df.filter(F.col(text).isNotNull())
    named = list(dict.fromkeys([*keys, *order]))
    placed = _begins(clean.select(*named, along.alias("_place"), F.length(text).alias("_n")), keys, order, F.col("_n"), cap, separator)
    # stored, so that the join knows how small it is
    kept = materialise(placed.select(*[F.col(c).alias(f"_k_{c}") for c in named]), "kept")
    same = F.lit(True)
    for c in named:
        same = same & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    few = clean.select(*named, along.alias("_place"), F.substring(text, 1, cap).alias("_t")).join(kept, same, "left_semi")
    # rows of equal order came along: the same again for the few
    few = _begins(materialise(few, "few"), keys, order, F.length("_t"), cap, separator)
    joined = few.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*order, "_t"))).alias("_p"))
    whole = F.array_join(F.transform("_p", lambda p: p["_t"]), separator)
    return joined.select(*keys, F.substring(whole, 1, cap).alias(out))


def _begins(df: DataFrame, keys: Sequence[str], order: Sequence[str], length: Column, cap: int, separator: str) -> DataFrame:
    """Rows that begin before the cap when the texts of a group are joined in order."""
    placed = running(df, keys, [F.col(c) for c in order], F.col("_place"), {"_at": ("sum", length + len(separator))}, include_current=False)
    return placed.filter(F.coalesce("_at", F.lit(0)) < cap)


def qa_dataset(documents: DataFrame, questions: DataFrame, answers: DataFrame, doc: str, question: str) -> DataFrame:
    """Question rows (a list per document is exploded first) with answer and source text."""
    asked = questions
    if dict(questions.dtypes)[question].startswith("array"):
        asked = questions.select(*[c for c in questions.columns if c != question], F.explode(question).alias(question))
    return asked.join(answers, [doc, question]).join(documents, doc)


# ---- evaluation -----------------------------------------------------------

def extraction_scores(df: DataFrame, predicted: str, truth: str) -> DataFrame:
    """Case-insensitive set precision and recall of extracted lists, per row."""
    def lower_set(c: str) -> Column:
        return F.array_distinct(F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda x: F.lower(F.trim(x))))
    p, q = lower_set(predicted), lower_set(truth)
    both = F.size(F.array_intersect(p, q)).cast("double")
    return df.withColumns({
        "precision": F.coalesce(F.try_divide(both, F.size(p)), F.lit(0.0)),
        "recall": F.coalesce(F.try_divide(both, F.size(q)), F.lit(0.0)),
    })


def feedback_dataset(requests: DataFrame, assessments: DataFrame) -> DataFrame:
    """Requests with the latest answer feedback and the collected retrieval feedback.

    ``assessments``: request_id, user_id, timestamp, rating, suggested_output,
    retrieval (a row has either a rating or a retrieval note). Of several
    ratings of a request the newest counts. Expected answer: the response when
    the rating is positive, else the suggestion if there is one.
    """
    rest = ["user_id", "timestamp", "rating", "suggested_output"]
    answer = assessments.filter("rating IS NOT NULL").groupBy("request_id").agg(
        F.max_by(F.struct(*rest), F.struct("timestamp", "user_id")).alias("_a")).select("request_id", "_a.*")
    notes = assessments.filter("retrieval IS NOT NULL").select("request_id", "user_id", "retrieval").distinct()
    notes = notes.groupBy("request_id", "user_id").agg(F.array_sort(F.collect_set("retrieval")).alias("retrieval_notes"))
    merged = answer.join(notes, ["request_id", "user_id"], "full").filter("rating IS NOT NULL")
    joined = merged.join(requests, "request_id")
    kind = F.when(F.col("rating") == "positive", "thumbs_up").when(F.col("rating") == "negative", "thumbs_down").otherwise("no_feedback_provided")
    wanted = F.when(F.col("rating") == "positive", F.col("response")).otherwise(F.nullif(F.col("suggested_output"), F.lit("")))
    return joined.select("request_id", "request", wanted.alias("expected_response"), kind.alias("type"), "user_id", "retrieval_notes")


def eval_queue(queue: DataFrame | None, log: DataFrame, request_id: str, rate: float, feedback: DataFrame | None = None, seed: int = 42) -> DataFrame:
    """Append unseen requests and mark them: a hash sample and all with feedback
    become ``todo``, the others ``skipped``. Rows marked before keep their mark,
    except that late feedback turns ``skipped`` into ``todo``."""
    fresh = log
    if queue is not None:
        fresh = log.join(queue.select(request_id), request_id, "left_anti")
    fresh = fresh.withColumn("eval_status", F.when(hash_share([request_id], seed) < rate, "todo").otherwise("skipped"))
    out = fresh if queue is None else queue.unionByName(fresh, allowMissingColumns=True)
    if feedback is not None:
        marked = feedback.select(request_id).distinct().withColumn("_fb", F.lit(True))
        out = out.join(marked, request_id, "left").withColumn(
            "eval_status", F.when((F.col("eval_status") == "skipped") & F.col("_fb"), "todo").otherwise(F.col("eval_status"))
        ).drop("_fb")
    return out


def quality_daily(df: DataFrame, ts: str, model: str, session: str, relevance: str, toxic: str) -> DataFrame:
    """Mean relevance, toxicity share and sessions per day and model version."""
    return df.groupBy(F.col(ts).cast("date").alias("day"), model).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(session).alias("sessions"),
        F.avg(relevance).alias("relevance"), F.avg(toxic).alias("toxicity"))
