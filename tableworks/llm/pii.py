"""Personal data: exact base patterns, and a semi-Markov conditional random field for what they leave."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernel import slices
from .scratch import Scratch, finish

KINDS = ("email", "ip", "card", "phone")
# What the field finds beside the base spans; order as in the output.
SOFT = ("soft_email", "soft_ip", "soft_card", "soft_phone", "secret")
ORDER = {k: i for i, k in enumerate(KINDS + SOFT)}
LABELS = ("none", *SOFT)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
# The look-behind changes no match: a run of digits that fails from its start fails from everywhere in it.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")



def _any_case(*words: str) -> str:
    """Pattern of the words in any case; spelt out, as the flag for it differs between Spark and Python."""
    return "(?:" + "|".join("".join(f"[{c.upper()}{c}]" for c in w) for w in words) + ")"


# What an entity of the field must hold, and a text to be looked at by Python at all: one pattern for both.
_ASSIGNED = _any_case("password", "passwd", "secret", "token", "key") + r"[\x22']?[ \t]{0,3}[=:][ \t]{0,3}[\x22']?[0-9A-Za-z]{12}"
HINT = rf"[0-9@]|[\[(]{_any_case('at', 'dot')}[\])]|{_ASSIGNED}"
_SEED = re.compile(HINT)

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Leftmost matches of each kind that pass its check, by start and kind. Offsets are code points, ends exclusive."""
    found: list[Span] = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append(("email", start, domain.end()))
            done = domain.end()
        at = text.find("@", max(at + 1, done))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = re.sub(r"[\x20-]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            found.append(("phone", m.start(), m.end()))
    return sorted(found, key=lambda s: (s[1], ORDER[s[0]]))


# --- the field -------------------------------------------------------------------------------------------------------

LONGEST = 4  # words of an entity
AROUND = 3  # words of context on either side of a word that may be part of one
WIDE = 48  # words of a window; longer runs of candidate words are decoded window by window
BUCKETS = 1 << 12
LONG_WORD = 60  # characters; longer words are cut at marks
REACH = 64  # characters kept on either side of a seed in a longer piece without marks
LONG_SPAN = 400  # characters; features of longer segments are not cached
_TRIM = ".,;:!?\"'()[]{}<>"
_WORD = re.compile(r"\S+")
_NAMED = re.compile(_ASSIGNED)
# Letters that are not Latin, in runs (hyphens of U+2010 to U+2015 stay with their neighbours); and all else.
_SCRIPT = re.compile("[\u0250-\u1dff\u1f00-\u200f\u2016-\U0010ffff]+|[^\u0250-\u1dff\u1f00-\u200f\u2016-\U0010ffff]+")
_PIECE = re.compile(r"[^\"'`{}<>|;,&?\\]+")


def _bucket(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "replace")) % BUCKETS


@lru_cache(maxsize=50_000)
def span_features(span: str, before: str, words: int) -> tuple[int, ...]:
    """Features of a whole candidate segment: its form, its counts, the checks it passes, the word before it."""
    core = span.strip(_TRIM) or span
    digits = "".join(c for c in core if "0" <= c <= "9")
    letters = sum(c.isalpha() for c in core)
    form = re.sub(r"d+", "d", re.sub(r"[A-Za-z]+", "a", re.sub(r"[0-9]+", "d", core)).replace("ad", "x").replace("da", "x"))
    form = re.sub(r"[^\x00-\x7f]+", "u", form)[:16]
    parts = core.split(".")
    names = [
        "bias", f"words{words}", f"form={form}", f"form={form}/words{words}", f"digits{min(len(digits), 20)}", f"size{min(len(core) // 4, 12)}",
        f"at{min(core.count('@'), 2)}", f"dots{min(core.count('.'), 4)}", f"letters{letters > 0}", f"plus{core[:1] == '+'}",
        f"mixed{bool(digits) and letters > 0 and len(core) >= 12}", f"hex{len(core) >= 12 and bool(digits) and all(c in '0123456789abcdef' for c in core)}",
        f"upper{len(core) >= 12 and bool(digits) and core.isascii() and core.isalnum() and core.upper() == core}",
        f"assigned{'=' in core and len(core.split('=')[-1]) >= 8}", f"luhn{len(digits) >= 12 and luhn(digits)}",
        f"quad{len(parts) == 4 and all(p.isdigit() and len(p) <= 3 for p in parts)}",
        f"word{any(w in core.lower() for w in ('[at]', '(at)', '[dot]', '(dot)'))}", f"named{_NAMED.search(core) is not None}",
        f"before={re.sub('[^a-z=:]', '', before.lower())[-10:]}", f"seed{_SEED.search(core) is not None}",
    ]
    return tuple(_bucket(n) for n in names)


class Field:
    """Weights of segment features by label, and of neighbouring labels."""

    def __init__(self):
        self.weights = np.zeros((BUCKETS, len(LABELS)))
        self.next = np.zeros((len(LABELS), len(LABELS)))

    def scores(self, words: list[str]) -> dict[tuple[int, int], tuple[np.ndarray, tuple[int, ...]]]:
        """Scores of all segments of up to ``LONGEST`` words; only single words can be ``none``, only seeds an entity."""
        out = {}
        for end in range(1, len(words) + 1):
            for start in range(max(0, end - LONGEST), end):
                span = " ".join(words[start:end])
                before = words[start - 1] if start else ""
                featured = span_features if len(span) + len(before) <= LONG_SPAN else span_features.__wrapped__
                features = featured(span, before, end - start)
                s = self.weights[list(features)].sum(axis=0)
                if end - start > 1:
                    s[0] = -np.inf
                if not _SEED.search(span):
                    s[1:] = -np.inf
                out[start, end] = (s, features)
        return out

    def forward(self, n: int, scores) -> np.ndarray:
        alpha = np.full((n + 1, len(LABELS)), -np.inf)
        alpha[0, 0] = 0
        for end in range(1, n + 1):
            parts = [_lse(alpha[start][:, None] + self.next) + scores[start, end][0] for start in range(max(0, end - LONGEST), end)]
            alpha[end] = _lse(np.stack(parts))
        return alpha

    def backward(self, n: int, scores) -> np.ndarray:
        beta = np.full((n + 1, len(LABELS)), -np.inf)
        beta[n] = 0
        for start in range(n - 1, -1, -1):
            parts = [_lse((self.next + (scores[start, end][0] + beta[end])[None, :]).T) for end in range(start + 1, min(n, start + LONGEST) + 1)]
            beta[start] = _lse(np.stack(parts))
        return beta

    def learn(self, words: list[str], gold: list[tuple[int, int, int]], rate: float) -> None:
        """One step up the likelihood of the segments ``gold`` (start, end, label; the rest is ``none``)."""
        n, scores = len(words), self.scores(words)
        alpha, beta = self.forward(n, scores), self.backward(n, scores)
        whole = _lse(alpha[n])
        pulled, chained = [], np.zeros_like(self.next)
        for (start, end), (s, features) in scores.items():
            joint = alpha[start][:, None] + self.next + (s + beta[end])[None, :] - whole
            p = np.exp(np.minimum(joint, 0.0))
            chained -= p
            pulled.append((features, -p.sum(axis=0)))
        covered, last, at = {a: (b, y) for a, b, y in gold}, 0, 0
        while at < n:
            end, y = covered.get(at, (at + 1, 0))
            chained[last, y] += 1
            one = np.zeros(len(LABELS))
            one[y] = 1
            pulled.append((scores[at, end][1], one))
            at, last = end, y
        for features, grad in pulled:
            np.add.at(self.weights, list(features), rate * grad)
        self.next += rate * chained

    def decode(self, words: list[str]) -> list[tuple[int, int, int]]:
        """The best segmentation: boundaries and types together, entities of bounded length."""
        n, scores = len(words), self.scores(words)
        best, back = np.full((n + 1, len(LABELS)), -np.inf), {}
        best[0, 0] = 0
        for end in range(1, n + 1):
            for start in range(max(0, end - LONGEST), end):
                via = best[start][:, None] + self.next
                come = via.argmax(axis=0)
                value = via.max(axis=0) + scores[start, end][0]
                for y in np.flatnonzero(value > best[end]):
                    best[end, y], back[end, y] = value[y], (start, int(come[y]))
        out, end, y = [], n, int(best[n].argmax())
        while end:
            start, previous = back[end, y]
            if y:
                out.append((start, end, y))
            end, y = start, previous
        return out[::-1]


def _lse(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=0)
    safe = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(x - safe).sum(axis=0)) + safe


def pieces(text: str) -> Iterator[tuple[int, int]]:
    """The words of a text as offsets, cut where the script changes; long words also at marks, and to the reach of their seeds."""
    for word in _WORD.finditer(text):
        for part in _SCRIPT.finditer(text, *word.span()):
            if part.end() - part.start() <= LONG_WORD:
                yield part.span()
                continue
            for piece in _PIECE.finditer(text, *part.span()):
                a, b = piece.span()
                if b - a <= LONG_WORD + 2 * REACH or not _SEED.search(text, a, b):
                    yield a, b
                    continue
                low = high = a
                for seed in _SEED.finditer(text, a, b):
                    if seed.start() - REACH > high:
                        if high > low:
                            yield low, high
                        low = seed.start() - REACH
                    high = min(b, seed.end() + REACH)
                yield low, high


def windows(text: str) -> Iterator[list[tuple[int, int]]]:
    """Runs of words (as offsets) around those that may be part of an entity."""
    words = list(pieces(text))
    seeds, at = [], 0
    for seed in _SEED.finditer(text):  # one may reach over several words
        while at < len(words) and words[at][1] <= seed.start():
            at += 1
        last = at
        while last < len(words) and words[last][0] < seed.end():
            if not seeds or seeds[-1] < last:
                seeds.append(last)
            last += 1
    low = 0
    while seeds:
        start = max(low, seeds[0] - AROUND)
        end = seeds[0] + 1
        taken = 0
        while taken < len(seeds) and seeds[taken] <= end + AROUND and seeds[taken] - start < WIDE:
            end = seeds[taken] + 1
            taken += 1
        seeds = seeds[taken:]
        stop = min(len(words), end + AROUND)
        yield words[start:stop]
        low = end


_SECRET = re.compile(rf"AKIA[0-9A-Z]{{16}}|{_ASSIGNED}[0-9A-Za-z]*")


def _training_window(text: str, words: list[tuple[int, int]]) -> tuple[list[str], list[tuple[int, int, int]]]:
    """Words of a window and its segments as the base patterns and the secret pattern show them."""
    base = base_spans(text)
    base += [("secret", m.start(), m.end()) for m in _SECRET.finditer(text)]
    gold, held = [], [text[a:b] for a, b in words]
    for kind, x, y in base:
        at = [i for i, (a, b) in enumerate(words) if a < y and x < b]
        if at and at[-1] - at[0] < LONGEST and not any(g[0] <= at[-1] and at[0] < g[1] for g in gold):
            gold.append((at[0], at[-1] + 1, LABELS.index(kind if kind == "secret" else f"soft_{kind}")))
    return held, gold


def _spoken(rng: np.random.Generator) -> tuple[list[str], int]:
    """An entity written in a way that the base patterns do not cover."""
    d = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    name = "".join(rng.choice(list("abcdefghijklmnoprstuvw"), 6))
    host = "".join(rng.choice(list("abcdefghijklmnoprstuvw"), 5))
    forms = [
        ([f"{name}[at]{host}[dot]com"], 1), ([f"{name}(at){host}.org"], 1), ([name, "[at]", f"{host}.com"], 1), ([f"{name}@{host}"], 1),
        ([f"{name[:3]}[dot]{name[3:]}(at){host}[dot]com"], 1), ([f"{name}[AT]{host}[DOT]com".upper()], 1),
        ([f"{name[:3]}[dot]{name[3:]}", "at", f"{host}[dot]com"], 1), ([f"{name}", "at", f"{host}(dot)org"], 1),
        ([f"{d(2)}[dot]{d(2)}[dot]{d(2)}[dot]{d(2)}"], 2),
        ([f"4{d(3)}.{d(4)}.{d(4)}.{d(4)}"], 3), ([f"4{d(3)}/{d(4)}/{d(4)}/{d(4)}"], 3),
        ([f"({d(3)})", f"555-{d(4)}"], 4), ([f"{d(3)}-555-{d(4)}"], 4), ([f"{d(3)}.555.{d(4)}"], 4), (["00" + d(2), d(3), d(7)], 4),
        ([f"sk-{''.join(rng.choice(list('0123456789abcdef'), 24))}"], 5), ([f"secret:{''.join(rng.choice(list('0123456789abcdef'), 20))}"], 5),
        ([f"{rng.choice(['password', 'token', 'secret', 'API_KEY'])}={''.join(rng.choice(list('abcdefghijklmnopqrstuvwxyz'), 16))}"], 5),
        (["password:", "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz0123456789"), 16))], 5),
    ]
    return forms[int(rng.integers(len(forms)))]


def train_field(texts: list[str], seed: int = 8, epochs: int = 4, most_windows: int = 900) -> Field:
    """Maximum likelihood, by single steps, on windows of the texts and on unusual spellings set into their words."""
    rng = np.random.Generator(np.random.PCG64(seed))
    examples, plain = [], [w for t in texts[:200] for w in t.split()[:60] if not _SEED.search(w) and len(w) < 20] or ["the", "of", "and"]
    for text in texts:
        for words in windows(text):
            examples.append(_training_window(text, words))
    examples = [examples[i] for i in rng.permutation(len(examples))[:most_windows]]
    pick = lambda n: [plain[i] for i in rng.integers(0, len(plain), n)]
    for _ in range(340):
        entity, y = _spoken(rng)
        left = pick(int(rng.integers(1, 4)))
        examples.append((left + entity + pick(int(rng.integers(1, 4))), [(len(left), len(left) + len(entity), y)]))
    for _ in range(160):  # numbers that are nothing of the kind
        number = str(rng.choice(["2.0.", "3.", f"{rng.integers(1900, 2100)}", f"{rng.integers(1, 999)},", f"{rng.integers(1, 99)}.{rng.integers(1, 99)}", f"{rng.integers(1000, 99999)}", f"{rng.integers(1, 28)}/{rng.integers(1, 12)}/{rng.integers(1990, 2030)}", f"10:{rng.integers(10, 59)}"]))
        left = pick(int(rng.integers(1, 4)))
        examples.append((left + [number] + pick(2), []))
    for name in ("key:", "token:", "Secret:"):  # a name before a long word assigns nothing
        for _ in range(12):
            examples.append((pick(2) + [name, "".join(pick(4))[:20].ljust(12, "e")] + pick(2), []))
    field = Field()
    for epoch in range(epochs):
        for i in rng.permutation(len(examples)):
            field.learn(*examples[i], rate=0.1 / (1 + epoch))
    return field


def soft_spans(text: str, field: Field, base: list[Span]) -> list[Span]:
    """Entities of the field that overlap no base span, without marks around them."""
    out = []
    for words in windows(text):
        for start, end, y in field.decode([text[a:b] for a, b in words]):
            a, b = words[start][0], words[end - 1][1]
            while a < b and text[a] in _TRIM:
                a += 1
            while b > a and text[b - 1] in _TRIM:
                b -= 1
            if a < b and not any(x < b and a < z for _, x, z in base) and not any(x < b and a < z for _, x, z in out):
                out.append((LABELS[y], a, b))
    return out


def find_pii(docs: DataFrame, train_rows: int = 1_500, train_bytes: int = 16 << 20, seed: int = 8, doc_id: str = "doc_id", text: str = "text",
             most_windows: int = 900) -> DataFrame:
    """Personal data of every whole text: doc_id, base, spans (both arrays of kind, start, end).

    ``base`` holds the matches of the exact patterns. The field scores candidate
    segments of up to four words around digits, ``@``, ``[at]`` and ``[dot]`` (in
    round or square marks and any case) and names like ``password`` that are
    given a value of 12 or more letters and digits, with features
    of the whole segment, and dynamic programming picks boundaries and types
    together; its segments that touch no base span are added to ``spans`` as
    ``soft_email``, ``soft_ip``, ``soft_card``, ``soft_phone`` and ``secret``,
    so the four base kinds count exactly what the patterns find. Words are cut
    where the script changes, and those above ``LONG_WORD`` characters at quotes,
    commas and other marks; where there are none, ``REACH`` characters around
    every such place are looked at. It is trained on
    the driver on at most ``train_rows`` texts with a hint of personal data
    (the smallest hashes of the id, ``train_bytes`` of text; a text that does not
    fit is passed over), of these on ``most_windows`` random windows labelled by
    the base patterns, and on generated unusual spellings among the first 60
    words of 200 of the texts.

    Null and empty texts, and texts without any such place, have no spans.
    Rows that repeat are handled each. A null id is kept. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession)
    spark = docs.sparkSession
    hint = F.col("text").rlike(HINT)
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn("text", F.when(hint, F.col("text")))
    base = scratch.write(base, "hinted")
    order = base.filter("text IS NOT NULL").select("doc_id", F.octet_length("text").alias("bytes"), F.xxhash64("doc_id", F.lit(seed)).alias("h"))
    ids, left = [], train_bytes
    order = order.filter(F.col("bytes") <= train_bytes)
    for r in order.orderBy("h", "doc_id").limit(train_rows).collect():  # ids only
        if r.bytes > left:
            continue
        left -= r.bytes
        if r.doc_id is not None:
            ids.append(r.doc_id)
    texts: list[str] = []
    if ids:
        wanted = spark.createDataFrame([(i,) for i in sorted(set(ids))], f"c_id {docs.schema[doc_id].dataType.simpleString()}")
        texts = sorted(r.text for r in base.join(F.broadcast(wanted), F.col("doc_id") == F.col("c_id")).filter("text IS NOT NULL").select("text").collect())
    shared = spark.sparkContext.broadcast(train_field(texts, seed, most_windows=most_windows))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for part in slices(batches, "text"):
            exact, every = [], []
            for t in part.column("text").to_pylist():
                found = base_spans(t) if t else []
                both = sorted(found + soft_spans(t, field, found), key=lambda s: (s[1], ORDER[s[0]])) if t else []
                for out, spans in ((exact, found), (every, both)):
                    out.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(exact, span), pa.array(every, span)], ["doc_id", "base", "spans"])

    kind = docs.schema[doc_id].dataType.simpleString()
    shape = "array<struct<kind:string,start:int,end:int>>"
    return finish(scratch, base.mapInArrow(find, f"doc_id {kind}, base {shape}, spans {shape}"), "pii")


def joined(spans: str):
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
