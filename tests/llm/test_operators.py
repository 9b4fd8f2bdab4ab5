"""Every operator against brute force, and on nulls, empty and long texts, ties, repeats, empty tables, clashing names."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tableworks.llm import decontaminate, embeddings, kernel, links, minhash, mixing, pii, planes, quality, sharding, spread, toxicity, warc
from tableworks.llm.queries import session
from tableworks.llm.scratch import Scratch

CLASHING = {"text": "string", "rank": "int", "n": "int", "cid": "int", "group": "int", "size": "int", "at": "int", "hub": "int", "taken": "int", "gone": "int", "_copy": "int"}
SCHEMA = "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} {t}" for c, t in CLASHING.items() if c != "text")


def doc(doc_id, text, source="a", lang="en"):
    return (doc_id, text, lang, source) + (7,) * (len(CLASHING) - 1)


LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
BASE = " ".join(f"term{i}" for i in range(60))
MESSY = [
    doc(1, BASE), doc(2, BASE), doc(3, BASE.replace("term30", "other")), doc(4, None), doc(5, ""), doc(6, " \t\n "), doc(7, "Two words"),
    doc(8, "two WORDS"), doc(9, LONG), doc(10, LONG + " end"), doc(None, BASE), doc(11, None, None, None), doc(12, "née Ünïcode 日本 words here now", "b"),
    doc(13, "one"), doc(13, "one"), doc(14, BASE, "c", None), doc(15, "a b c d e f", "b"),
]


@pytest.fixture(scope="module")
def s(spark):
    return session(spark)


@pytest.fixture(scope="module")
def messy(s):
    return s.createDataFrame(MESSY, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(s):
    return s.createDataFrame([], SCHEMA)


def collected(df, *columns):
    return sorted((tuple(r[c] for c in columns or df.columns) for r in df.collect()), key=repr)


# --- building blocks ---------------------------------------------------------------------------------------------------


def test_words_follow_the_pattern():
    texts = ["", None, " a  B\tc\x0bd ", "é ÉCOLE x", LONG[:5000], "x"]
    w = kernel.words(pa.array(texts))
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    want = [re.findall(r"[^\x20\x09-\x0D]+", lower(t)) for t in texts]
    assert np.diff(w.first).tolist() == [len(x) for x in want]
    seen = {}
    for h, word in zip(w.hashes.tolist(), [x for part in want for x in part]):
        assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def test_components_of_a_star_a_path_and_a_ring(s):
    edges = [(0, i) for i in range(1, 300)] + [(1000 + i, 1001 + i) for i in range(40)] + [(2000 + i, 2000 + (i + 1) % 7) for i in range(7)] + [(5000, 5000)]
    got = dict(collected(spread.components(s.createDataFrame(edges, "a long, b long"), Scratch(s))))
    assert all(got[i] == 0 for i in range(300)) and all(got[1000 + i] == 1000 for i in range(41)) and all(got[2000 + i] == 2000 for i in range(7))
    assert 5000 not in got


def test_numbers_are_gapless_in_groups(s):
    rows = [(g, (i * 7919) % 500) for g in (None, "a", "b") for i in range(400 if g == "a" else 30)]
    got = spread.number_rows(s.createDataFrame(rows, "g string, v int"), ["g"], ["v"], Scratch(s), "k").collect()
    for g in (None, "a", "b"):
        mine = sorted((r.v, r.k) for r in got if r.g == g)
        assert [k for _, k in mine] == list(range(len(mine)))


def test_quota_cut_equals_a_sorted_sum(s):
    rng = np.random.default_rng(1)
    rows = [(int(g), int(r), int(x)) for g, r, x in zip(rng.integers(0, 3, 500), rng.integers(0, 2**48, 500), rng.integers(0, 50, 500))] + [(4, 5, 1)]
    quotas = {0: 1000, 1: 0, 2: 10**6, 4: 1}
    got = spread.quota_cut(s.createDataFrame(rows, "g int, rank long, size int"), Scratch(s).write(s.createDataFrame(list(quotas.items()), "g int, quota long")), "g", Scratch(s))
    for r in got.collect():
        run, cut = 0, None
        for rank, size in sorted((b, c) for a, b, c in rows if a == r.g):
            if run + size > quotas[r.g]:
                cut = rank
                break
            run += size
        assert (r.cut, r.filled) == (cut, None if cut is None else run)


def test_local_roots():
    assert links.local_roots(6, np.array([5, 4, 1]), np.array([4, 3, 0])).tolist() == [0, 0, 2, 3, 3, 3]
    assert links.local_roots(2, np.empty(0, int), np.empty(0, int)).tolist() == [0, 1]


# --- op1 ---------------------------------------------------------------------------------------------------------------


def test_mix_meets_its_targets_and_is_repeatable(s, messy):
    rows = [doc(i, " ".join(["w"] * (1 + i * 37 % 90)), f"s{i % 7}") for i in range(1400)]
    docs = s.createDataFrame(rows, SCHEMA)
    got = mixing.mix_sources(docs).collect()
    assert collected(mixing.mix_sources(docs.repartition(5))) == sorted(map(tuple, got), key=repr)
    taken, target, size = Counter(), {}, Counter()
    for r in got:
        assert r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
        target[r.source], size[r.source] = r.target, r.source_size
    assert abs(sum(target.values()) - 1.5 * sum(size.values())) < 1e-6
    assert all(abs(taken[k] - target[k]) <= 5 for k in target)
    out = mixing.mix_sources(messy).collect()
    assert len(out) == len(MESSY) and all(r.size == 0 and r.taken == 0 for r in out if r.doc_id in (4, 5, 6))
    mixed = mixing.mixed_documents(messy)
    assert mixed.columns == messy.columns
    want = Counter({})
    for r in out:
        want[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in mixed.collect()) == +want


def test_mix_meets_its_targets_beside_very_long_documents(s):
    """Three sources of 300 short texts with one of a third of all words each: the long ones do not keep any from its target."""
    rng = np.random.default_rng(12)
    for seed in range(2):
        rows = [doc(1000 * k + i, " ".join(["w"] * (5000 if i == 0 else int(rng.integers(10, 61)))), f"s{k}") for k in range(3) for i in range(300)]
        got = mixing.mix_sources(s.createDataFrame(rows, SCHEMA), seed=f"seed {seed}").collect()
        for k in range(3):
            mine = [r for r in got if r.source == f"s{k}"]
            assert abs(sum(r.taken for r in mine) - mine[0].target) <= 60


def test_mix_of_nothing(empty):
    assert mixing.mix_sources(empty).collect() == [] and mixing.mixed_documents(empty).collect() == []


# --- op2 ---------------------------------------------------------------------------------------------------------------


def test_embeddings_equal_brute_force(s):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(12, 16))
    rows = [(i, [float(x) for x in centre[i % 12] + rng.normal(size=16) * 0.04 * (i % 5)], i % 2) for i in range(240)]
    rows += [(900, rows[0][1], 0), (901, None, 0), (902, [0.0] * 16, 0), (903, [float("nan")] + [1.0] * 15, 0), (904, [float("inf")] + [1.0] * 15, 0), (905, [None] + [1.0] * 15, 0),
             (906, rows[0][1], None), (907, rows[0][1][:8], 0), (908, [x * 1e-30 for x in rows[0][1]], 0), (909, [], 0), (900, rows[0][1], 0), (None, rows[0][1], 0)]
    got = embeddings.near_embeddings(s.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), tile_rows=50).collect()
    good = [(i, np.array(v, float), y) for i, v, y in rows if i is not None and v and y is not None and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    n, reach = [0] * len(good), {i: {i} for i, _, _ in good}
    for a in range(len(good)):
        for b in range(a):
            (i, x, p), (j, y, q) = good[a], good[b]
            if p == q and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98:
                n[a] += 1
                n[b] += 1
                both = reach[i] | reach[j]
                for k in both:
                    reach[k] = both
    want = sorted([(i, k, min(reach[i]), i == min(reach[i])) for (i, _, _), k in zip(good, n)]
                  + [(i, 0, i, True) for i in (901, 902, 903, 904, 905, 906, 909)] + [(None, 0, None, True)], key=repr)
    assert sorted(map(tuple, got), key=repr) == want


def test_quantised_products_miss_nothing():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 24))
    y = np.concatenate([x[:100] + rng.normal(size=(100, 24)) * 0.1, rng.normal(size=(50, 24))])
    x, y = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (x, y))
    for t in (0.98, 0.9, 0.3):
        i, j = embeddings.linked_pairs(x, y, t)
        assert set(zip(i.tolist(), j.tolist())) == set(zip(*(z.tolist() for z in np.nonzero(x @ y.T >= t))))


def test_embeddings_of_nothing(s):
    assert embeddings.near_embeddings(s.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []


# --- op3 ---------------------------------------------------------------------------------------------------------------


def test_toxicity_learns_held_out_rows(s, messy):
    rng = np.random.default_rng(0)
    plain = [f"{a}{b}" for a in ("ta", "mo", "ri", "se", "lu") for b in ("na", "ko", "ver", "dim", "pol", "gra")]
    bad = ["vexalo", "vexami", "vexaro"]
    rows, marks = [], []
    for i in range(700):
        words = list(rng.choice(plain, int(rng.integers(20, 60))))
        toxic = i % 4 == 0
        for k in range(3 if toxic else 0):
            words[int(rng.integers(len(words)))] = bad[(i + k) % 3]
        rows.append(doc(i, " ".join(words), lang=("en", "de")[i % 2]))
        marks.append((i, 1, int(toxic)))
    labels = s.createDataFrame(marks + [(0, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.score_toxicity(s.createDataFrame(rows, SCHEMA), labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == int(r.doc_id % 4 == 0) for r in held) >= 0.95 * len(held)
    out = toxicity.score_toxicity(messy, labels.limit(0)).collect()
    assert len(out) == len(MESSY) and all(r.score == 0 for r in out)


def test_toxicity_sample_passes_over_a_text_that_does_not_fit(s, monkeypatch):
    seen = []

    def train(texts, y, seed):
        seen.extend(texts)
        return toxicity.Model.fresh(seed)

    monkeypatch.setattr(toxicity, "train", train)
    ids = [r.id for r in s.range(60).orderBy(F.xxhash64("id", F.lit(3))).collect() if zlib.crc32(str(r.id).encode()) % 5]
    fit = s.range(60).filter(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(5)) != 0)
    fit = {r.id for r in fit.collect()}
    first = next(i for i in ids if i in fit and i % 2)
    docs = s.createDataFrame([doc(i, "long " * 2000 if i == first else f"word{i}") for i in range(60)], SCHEMA)
    labels = s.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    toxicity.score_toxicity(docs, labels, sample_bytes=3000)
    assert sorted(seen) == sorted(f"word{i}" for i in ids if i in fit and i != first)


def test_toxicity_learns_rows_outside_the_sample(s):
    rng = np.random.default_rng(1)
    plain = [f"{a}{b}" for a in ("ta", "mo", "ri", "se", "lu") for b in ("na", "ko", "ver", "dim", "pol", "gra")]
    docs = s.createDataFrame([doc(i, " ".join([*rng.choice(plain, 20), "vexalo" if i % 4 == 0 else "plain"])) for i in range(400)], SCHEMA)
    labels = s.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    got = toxicity.score_toxicity(docs, labels, sample_bytes=0, passes=20).filter("held_out").collect()
    assert sum(r.predicted == int(r.doc_id % 4 == 0) for r in got) >= 0.95 * len(got)


def test_toxicity_thresholds_count_every_check_row(s):
    bins = s.createDataFrame([("en", 300, 40, 0), ("en", 100, 10, 5), ("en", -200, 2, 900), ("de", 5, 3, 900)], "lang string, bin int, up long, down long")
    got = toxicity.thresholds_by(bins, (1.0, 0.0)).collect()
    assert [r.lang for r in got] == ["en"] and np.isclose(got[0].threshold, 1 / (1 + np.exp(50 / toxicity.BINS)))


def test_convolution_by_look_up_equals_the_direct_form():
    model = toxicity.Model.fresh(1)
    texts = ["alpha beta gamma delta", "", "one", None]
    ids = toxicity.encode(pa.array(texts))
    fast = toxicity.pooled(ids, toxicity.feature_maps(ids, model.tables(), model.bias))
    for k, (a, b) in enumerate(zip(ids.start, ids.stop)):
        e = np.zeros((b - a + 3, toxicity.DIMS), np.float32)
        for p in range(a, b):
            e[p - a] = model.embed[0][ids.word[p]] + model.embed[1][ids.stem[p]]
        direct = np.concatenate([np.max([sum(e[p + q] @ f[q] for q in range(len(f))) + c for p in range(b - a)], axis=0) for f, c in zip(model.filters, model.bias)])
        assert np.allclose(np.maximum(direct, 0), fast[k], atol=1e-5)


# --- op4 ---------------------------------------------------------------------------------------------------------------


def test_warc_round_trip(s):
    pages = [(1, "http://a", "<p>x</p>"), (2, "http://b", "<p>x</p>"), (3, None, None), (4, "u", ""), (5, "u r l", "é\r\n\r\nWARC/1.1\r\n"), (6, "z", LONG), (2, "http://b", "<p>x</p>"), (None, "n", "<p>x</p>")]
    df = s.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit(1)).repartition(3)
    top = defaultdict(int)
    for i, _, h in pages:
        top[h or ""] = max(top[h or ""], i or 0)
    want = []
    for i, _, h in pages:
        raw = (h or "").encode()
        first = i == top[h or ""]
        want.append((i, len(raw), warc.base32_sha1(raw), "response" if first else "revisit", None if first else top[h or ""]))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert collected(warc.archive_pages(df), *columns) == sorted(want, key=repr)
    few = warc.archive_pages(df, least_bytes=1)
    assert {r.record_type for r in few.collect() if r.payload_bytes == 0} == {"response"}
    assert warc.archive_pages(df.limit(0)).collect() == []


def test_normaliser_makes_members_and_an_index(tmp_path):
    import gzip

    whole = b"".join(warc.record(i, f"u{i}", b"payload %d\r\n\r\n" % i * i, None, True, "2024-01-01T00:00:00Z") for i in range(50))
    (tmp_path / "one.warc.gz").write_bytes(gzip.compress(whole[:3000]) + gzip.compress(whole[3000:]))
    target = str(tmp_path / "two.warc.gz")
    assert warc.normalise(str(tmp_path / "one.warc.gz"), target) == 50
    data = (tmp_path / "two.warc.gz").read_bytes()
    assert gzip.decompress(data) == whole
    for line in (tmp_path / "two.warc.gz.idx").read_text().splitlines():
        offset, length = map(int, line.split("\t")[:2])
        assert gzip.decompress(data[offset:offset + length]).startswith(b"WARC/1.1")
    assert len(list(warc.read_indexed(target))) == 50
    (tmp_path / "cut.warc.gz").write_bytes(gzip.compress(whole[:-40]))
    with pytest.raises(ValueError):
        warc.normalise(str(tmp_path / "cut.warc.gz"), str(tmp_path / "three.warc.gz"))


# --- op5 ---------------------------------------------------------------------------------------------------------------

TOKENIZER = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


@pytest.mark.parametrize("kind", ["bit", "byte"])
def test_planes_round_trip(tmp_path, kind):
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, 2**32 if i == 3 else 49_408, n, dtype=np.uint32) for i, n in enumerate([0, 5, planes.BLOCK, 3 * planes.BLOCK + 7, 1])]
    with planes.writing(str(tmp_path / "f")) as out:
        file = planes.PlaneWriter(out, kind)
        for i, ids in enumerate(docs):
            file.add(np.array([i - 2]), np.array([len(ids)]), ids)
        file.close()
    with planes.reading(str(tmp_path / "f")) as source:
        got = list(planes.PlaneReader(source).documents())
    assert got == [(i - 2, len(d), zlib.crc32(d.astype("<u4").tobytes())) for i, d in enumerate(docs)]


def test_encoder_equals_the_library(tables):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(TOKENIZER)
    odd = ["", None, "Don't it's I'LL we've 'S a'b", "é x́ Å", "İstanbul ΑΣ Σ", "a b　c\x1cd", "日本語 123,456", "<|startoftext|> A<|endoftext|>b", "ǅ ß STRASSE ẞ",
           "!!! a.b.c ...(x) x; y≠≠ don't. A…! é… É×!", "\t", "≠ a̸"]
    texts = [r.text for r in tables.documents.select("text").limit(60).collect()] + odd
    want = [e.ids for e in whole.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    library = planes.Encoder(TOKENIZER)
    for group in (texts, texts[:5], odd, [t for t in odd if not t or "<|" not in t]):
        ids, sizes = library.encode(pa.array(group, pa.string()))
        at = np.cumsum(sizes) - sizes
        assert [ids[a:a + n].tolist() for a, n in zip(at, sizes)] == [want[texts.index(t)] for t in group]


def test_token_files(s, messy, empty):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(TOKENIZER)
    got = planes.write_token_planes(messy, TOKENIZER).collect()
    start = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == start
        start += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0)) and len(got) == len(MESSY)
    crc = lambda t: zlib.crc32(np.array(whole.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes())
    assert sorted((r.doc_id, r.ids_crc32) for r in got if r.doc_id is not None) == sorted((d[0], crc(d[1])) for d in MESSY if d[0] is not None)
    assert planes.write_token_planes(empty, TOKENIZER).collect() == []


# --- op6 ---------------------------------------------------------------------------------------------------------------


def test_quality_keeps_good_and_drops_junk(s, messy, empty):
    rng = np.random.default_rng(4)
    plain = ["the", "river", "stone", "and", "of", "bridge", "old", "town", "quiet", "market"]
    rows, marks = [], []
    for i in range(600):
        junk = i % 6 == 0
        text = " ".join([f"zx{i}"] * 60 if junk else rng.choice(plain, 60))
        rows.append(doc(i, text))
        marks.append((i, int(not junk)))
    labels = s.createDataFrame(marks[::2] + marks[1::4] + [(None, 1), (3, None)], "doc_id long, quality int")
    docs = s.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r for r in quality.importance_resample(docs, labels).collect()}
    assert all(not got[i].kept for i in range(0, 600, 6)) and sum(got[i].kept for i in range(600) if i % 6) >= 495
    kept = sorted(r.draw for r in got.values() if r.kept)
    assert max(r.draw for r in got.values() if not r.kept) < kept[0]  # the largest noisy weights, no others
    out = quality.good_documents(messy, labels)
    assert out.columns == messy.columns
    assert quality.good_documents(messy, labels.limit(0)).count() == len(MESSY)
    assert quality.importance_resample(empty, labels).collect() == []


# --- op7 ---------------------------------------------------------------------------------------------------------------


def brute_near(rows, k, per_cent):
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    sets = []
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(r[1]))
        sets.append({tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    reach = {r[0]: {r[0]} for r in rows if r[0] is not None}
    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and None not in (rows[a][0], rows[b][0]) and 100 * len(x & y) >= per_cent * len(x | y):
                both = reach[rows[a][0]] | reach[rows[b][0]]
                for i in both:
                    reach[i] = both
    return sorted(((r[0], len(x), min(reach[r[0]]) if r[0] is not None else None, r[0] is None or min(reach[r[0]]) == r[0]) for r, x in zip(rows, sets)), key=repr)


def test_near_duplicates_equal_brute_force(s, messy, empty, monkeypatch):
    assert collected(minhash.near_duplicates(messy, shingle=3, similarity=0.85)) == brute_near(MESSY, 3, 85)
    rng = np.random.default_rng(6)
    rows = []
    for i in range(160):
        words = [f"g{i % 4}t{k}" for k in range(80)]
        for _ in range(i // 4 % 9):
            words[int(rng.integers(80))] = f"edit{int(rng.integers(10_000))}"
        rows.append(doc(i, " ".join(words)))
    monkeypatch.setattr(minhash, "TILE_ROWS", 12)
    docs = s.createDataFrame(rows, SCHEMA)
    assert collected(minhash.near_duplicates(docs, shingle=3, similarity=0.85)) == brute_near(rows, 3, 85)
    kept = minhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    again = s.createDataFrame([doc(1, BASE), doc(13, BASE), doc(13, "a third text found nowhere else"), doc(13, "a third text found nowhere else"), doc(None, BASE), doc(14, "")], SCHEMA)
    assert sorted((str(r.doc_id), r.text[:3]) for r in minhash.without_near_duplicates(again).collect()) == [("1", "ter"), ("13", "a t"), ("14", ""), ("None", "ter")]
    # 100 shingles and 80.1 % in common: apart at 0.804, linked at 0.8
    long = [f"u{i}" for i in range(1000)]
    pair = s.createDataFrame([doc(1, " ".join(long)), doc(2, " ".join(long[:890] + [f"v{i}" for i in range(110)]))], SCHEMA)
    shared, union = 890 - 2, 2 * 998 - (890 - 2)
    assert 0.8 < shared / union < 0.804
    assert [sum(r.kept for r in minhash.near_duplicates(pair, shingle=3, similarity=x).collect()) for x in (0.8, 0.804)] == [1, 2]
    assert sorted(r.doc_id for r in kept.collect()) == [r[0] for r in sorted(brute_near(rows, 5, 80), key=lambda r: r[0]) if r[3]]
    assert minhash.near_duplicates(empty).collect() == []


@pytest.fixture
def plans(monkeypatch):
    """Spark's first plan of every table that is written while a test runs, by its label: a broadcast in it is never taken back."""
    seen, write = defaultdict(list), Scratch.write

    def noted(self, df, label="step"):
        seen[label].append(df._jdf.queryExecution().executedPlan().toString())
        return write(self, df, label)

    monkeypatch.setattr(Scratch, "write", noted)
    return seen


def test_near_duplicates_broadcast_no_table_that_grows(s, messy, plans):
    assert s.conf.get("spark.sql.autoBroadcastJoinThreshold") == "10485760b"
    minhash.near_duplicates(messy, shingle=3, similarity=0.85)
    assert s.conf.get("spark.sql.autoBroadcastJoinThreshold") == "10485760b"
    # 81 keys of a class, a seat for each of a cell's tiles, rows of ids that files hold in a few bytes
    joined = [label for label, of in plans.items() if any("Join" in p for p in of)]
    assert {"pairs", "cells", "links", "edges", "near-duplicates"} <= set(joined)
    # cells are broadcast where they are counted and few
    assert [label for label in joined if any("Broadcast" in p for p in plans[label])] == ["asked"]
    assert "might_contain" in plans["links"][0]


def test_a_counted_table_is_broadcast_only_where_it_is_small(s, monkeypatch):
    small = Scratch(s).write(s.range(10).select("id", (F.col("id") * 2).alias("twice")))
    plan = lambda: spread.attach(s.range(30), small, ["id"], "left")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan()
    monkeypatch.setattr(spread, "SMALL_ROWS", 9)
    assert "SortMergeJoin" in plan()


def test_tensor_size_keeps_the_promise():
    for similarity, rows in ((0.85, 2), (0.8, 2), (0.8, 3)):
        m = minhash.collections_for(similarity, rows, 2e-5)
        assert 2 * (1 - similarity**rows) ** m <= 2e-5 < 2 * (1 - similarity**rows) ** (m - 1)
    assert minhash.collections_for(1.0, 2, 1e-5) == 1


# --- op8 ---------------------------------------------------------------------------------------------------------------

CHECKS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda t: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda t: all(int(p) <= 255 for p in t.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda t: 12 <= len(re.sub("[ -]", "", t)) <= 19 and pii.luhn(re.sub("[ -]", "", t))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: 9 <= len(re.sub("[^0-9]", "", t)) <= 15),
}


def plain_spans(text):
    return sorted(((k, m.start(), m.end()) for k, (p, ok) in CHECKS.items() for m in re.finditer(p, text) if ok(m[0])), key=lambda x: (x[1], pii.KINDS.index(x[0])))


def test_base_patterns_equal_the_plain_form(tables):
    rng = np.random.default_rng(9)
    alphabet = list("0123456789019283..@@--++ ()ab%_é,")
    texts = ["".join(rng.choice(alphabet, 60)) for _ in range(3000)]
    texts += ["a@b@c.de", "x@y.z@w.vu", "é.a@b.co.", "1.2.3.4.5.6.7.8", "001.002.003.0255", "256.1.1.1", "4111 1111-1111 1111", "+1 (918) 555-4124 +", "@a.b", "a@b", "", "..@a.b-.c"]
    texts += [r.text for r in tables.documents.select("text").collect()]
    for t in texts:
        assert pii.base_spans(t) == plain_spans(t), t


def test_field_adds_spans_and_leaves_prose_alone(s, messy, empty, tables):
    plain = "Call me at (212) 555-0187 please, or write to anna[at]mail[dot]com about the year 1999 and version 2.0 of it"
    docs = s.createDataFrame([doc(1, plain), doc(2, "mail a.b@c.de from 10.0.0.1"), doc(3, "Licensed under version 2.0."), doc(4, None)], SCHEMA)
    got = {r.doc_id: r for r in pii.find_pii(docs.unionByName(tables.documents.select("doc_id", "text", "lang", "source", *[F.lit(1).alias(c) for c in docs.columns[4:]]).withColumn("doc_id", F.col("doc_id") + 100))).collect()}
    kinds = lambda i: [x["kind"] for x in got[i].spans]
    assert kinds(1) == ["soft_phone", "soft_email"] and got[1].base == []
    assert plain[got[1].spans[1]["start"]:got[1].spans[1]["end"]] == "anna[at]mail[dot]com"
    assert kinds(2) == ["email", "ip"] and kinds(3) == [] and kinds(4) == []
    assert len(pii.find_pii(messy).collect()) == len(MESSY) and pii.find_pii(empty).collect() == []


def test_pii_query_counts_the_base_kinds(s, tables):
    from tableworks.llm.queries import QUERIES

    text = {r.doc_id: r.text for r in tables.documents.collect()}
    got = QUERIES["op8_pii_semi_markov"](s, tables.folder).collect()
    assert len(got) == len(text)
    for r in got:
        want = plain_spans(text[r.doc_id])
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(w[0] == k for w in want) for k in pii.KINDS]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest()
        assert {f"{k}:{a}:{b}" for k, a, b in want} <= set(r.spans.split(","))


def test_field_looks_into_long_unbroken_runs(tables):
    address = "john[at]example[dot]com"
    field = pii.train_field([r.text for r in tables.documents.orderBy("doc_id").limit(300).collect() if r.text and re.search(pii.HINT, r.text)])
    runs = ["\u6f22\u5b57" * 150, '{"k":"' + '","k":"'.join(["plain words".replace(" ", "_")] * 30) + '","mail":"', "https://host/" + "/".join(["path"] * 70) + "?mail=", "\u0e01" * 300]
    for run in runs:
        for after in ("", "\u6f22" * 300, '","z":"' + "q" * 300):
            text = run + address + after
            assert len(run) >= 300 and not re.search(r"\s", text)
            found = [text[a:b] for k, a, b in pii.soft_spans(text, field, []) if k == "soft_email"]
            assert len(found) == 1 and address in found[0] and len(found[0]) < 40, (run[:20], found)
    text = "q" * 300 + address
    assert any(k == "soft_email" and text[a:b].endswith(address) for k, a, b in pii.soft_spans(text, field, []))
    # every seed is in a piece, whatever is around it
    rng = np.random.default_rng(2)
    for _ in range(300):
        text = "".join(rng.choice(["q" * 150, "1", "[at]", "\u6f22" * 90, " ", '"', "x@y", "q.", "\u2011"], 12))
        cut = list(pii.pieces(text))
        assert all(a < b <= c for (a, b), (c, _) in zip(cut, cut[1:]))
        assert all(any(a <= m.start() and m.end() <= b for a, b in cut) for m in pii._SEED.finditer(text))


def test_every_spelling_is_seen_without_an_unrelated_digit(s, tables):
    cases = [
        ("please write to john[dot]doe at example[dot]com", "soft_email", "john[dot]doe at example[dot]com"),
        ("please write to JOHN[AT]EXAMPLE[DOT]COM or call", "soft_email", "JOHN[AT]EXAMPLE[DOT]COM"),
        ("please write to john[dot]doe(at)example[dot]com or call", "soft_email", "john[dot]doe(at)example[dot]com"),
        ("then set password=abcdefghijklmnop in the file", "secret", "password=abcdefghijklmnop"),
        ("then set Token=qwertyzuiopasdfg in the file", "secret", "Token=qwertyzuiopasdfg"),
    ]
    clean = ["The key: understanding how tables grow", "a token of thanks and a secret = never told", "no dot at all here"]
    texts = [t for t, _, _ in cases] + clean
    rows = [doc(i, t) for i, t in enumerate(texts)] + [doc(100 + i, t + " , and so on until line 7 ends") for i, t in enumerate(texts)]
    docs = s.createDataFrame(rows, SCHEMA).select("doc_id", "text").unionByName(tables.documents.select((F.col("doc_id") + 1000).alias("doc_id"), "text"))
    got = {r.doc_id: [(x.kind, x.start, x.end) for x in r.spans] for r in pii.find_pii(docs).filter("doc_id < 1000").collect()}
    for i, (text, kind, span) in enumerate(cases):
        assert [(k, text[a:b]) for k, a, b in got[i]] == [(kind, span)], (text, got[i])
        assert got[100 + i] == got[i]
    for i in range(len(cases), len(texts)):
        assert got[i] == [] and got[100 + i] == [], texts[i]


def test_field_sample_passes_over_a_text_that_does_not_fit(s, monkeypatch):
    seen = {}
    monkeypatch.setattr(pii, "train_field", lambda texts, seed, most_windows: seen.update(texts=texts, most=most_windows) or pii.Field())
    rows = [doc(i, f"call 55{i}") for i in range(40)]
    first = s.createDataFrame(rows, SCHEMA).orderBy(F.xxhash64("doc_id", F.lit(8))).first().doc_id
    rows[first] = doc(first, "1 " * 3000)
    pii.find_pii(s.createDataFrame(rows, SCHEMA), train_bytes=2000, most_windows=7)
    assert len(seen["texts"]) == 39 and seen["most"] == 7


def test_segmentation_is_the_best_of_all():
    field = pii.Field()
    rng = np.random.default_rng(1)
    field.weights, field.next = rng.normal(size=field.weights.shape), rng.normal(size=field.next.shape)
    words = ["a", "1", "b2", "@", "c"]
    scores = field.scores(words)

    def every(at, last):
        if at == len(words):
            yield 0.0, []
        for end in range(at + 1, min(len(words), at + pii.LONGEST) + 1):
            for y in range(len(pii.LABELS)):
                gain = scores[at, end][0][y] + field.next[last, y]
                if np.isfinite(gain):
                    for rest, path in every(end, y):
                        yield gain + rest, ([(at, end, y)] if y else []) + path

    paths = list(every(0, 0))
    assert field.decode(words) == max(paths, key=lambda p: p[0])[1]
    total = pii._lse(field.forward(len(words), scores)[len(words)])
    assert np.isclose(total, pii._lse(np.array([p[0] for p in paths])))
    assert np.isclose(field.backward(len(words), scores)[0, 0], total)


# --- op9 ---------------------------------------------------------------------------------------------------------------


def test_shards_are_even_and_keep_groups(s, messy, empty):
    rows = [doc(i, "hot" if i % 3 == 0 else f"text {i // 8}" if i % 3 == 1 else f"single {i}") for i in range(900)]
    got = sharding.shard_documents(s.createDataFrame(rows, SCHEMA), shards=10).collect()
    count = Counter(r.shard for r in got)
    assert sorted(count) == list(range(10)) and set(count.values()) == {90}
    for k in count:
        assert sorted(r.slot for r in got if r.shard == k) == list(range(count[k]))
    text = {r[0]: r[1] for r in rows}
    places = defaultdict(set)
    for r in got:
        places[text[r.doc_id]].add(r.shard)
        assert r.size == len(text[r.doc_id]) + 16 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode())
    assert len(places.pop("hot")) <= 6 and sum(len(p) > 1 for p in places.values()) == 0
    out = sharding.shard_documents(messy, shards=4).collect()
    assert len(out) == len(MESSY) and max(Counter(r.shard for r in out).values()) - min(Counter(r.shard for r in out).values()) <= 1
    assert sharding.shard_documents(empty).collect() == []


def test_a_hot_group_goes_to_the_fewest_shards(s):
    for beside in (lambda i: f"single {i}", lambda i: f"pair {i // 3}"):
        rows = [doc(i, "hot" if i % 3 == 0 else beside(i)) for i in range(6000)]
        got = sharding.shard_documents(s.createDataFrame(rows, SCHEMA)).collect()
        assert set(Counter(r.shard for r in got).values()) == {150} and len({r.doc_id for r in got}) == 6000
        places = defaultdict(set)
        for r in got:
            places[rows[r.doc_id][1]].add(r.shard)
        assert len(places.pop("hot")) == 14 and sum(len(p) > 1 for p in places.values()) == 0


def test_a_table_of_groups_only_keeps_them_whole(s):
    rows = [doc(i, f"pair {i // 2}") for i in range(2400)]
    got = sharding.shard_documents(s.createDataFrame(rows, SCHEMA)).collect()
    assert set(Counter(r.shard for r in got).values()) == {60}
    places = defaultdict(set)
    for r in got:
        places[r.doc_id // 2].add(r.shard)
    assert len(places) == 1200 and all(len(p) == 1 for p in places.values())


def link_groups(s, sizes, shards, seed):
    """Groups of the given sizes whose documents lie in random shards, as ``propagate`` takes them."""
    rng, rows = np.random.default_rng(seed), []
    for g, m in enumerate(sizes):
        at = Counter(rng.integers(0, shards, m).tolist())
        rows.append((g.to_bytes(4, "big"), m, sorted(((n, int(rng.integers(100)), k) for k, n in at.items()), reverse=True)))
    return s.createDataFrame(rows, f"group binary, members long, near {sharding._NEAR}")


@pytest.mark.parametrize("high, groups, spare", [(3, 300, 0), (20, 120, 0), (40, 60, 5), (20, 120, 400)])
def test_labels_propagate_under_quotas(s, high, groups, spare):
    sizes = np.random.default_rng(high).integers(2, high, groups).tolist()
    total = sum(sizes) + spare
    quotas = [total // 10 + (k < total % 10) for k in range(10)]
    scratch = Scratch(s)
    moves, rooms = sharding.propagate(link_groups(s, sizes, 10, 3), quotas, scratch)
    rounds = [m.collect() for m in moves]
    settled = {int.from_bytes(r.group, "big"): r for rows in rounds for r in rows}
    assert len(settled) == sum(map(len, rounds)) and all(r.members == sizes[g] for g, r in settled.items())
    taken = Counter()
    for r in settled.values():
        taken[r.shard] += r.members
    assert rooms == [q - taken[k] for k, q in enumerate(quotas)] and min(rooms) >= 0
    # no group stays apart that would fit a shard whole, and every round joins links that were cut
    assert all(sizes[g] > max(rooms) for g in range(groups) if g not in settled)
    assert all(sum(r.members - r.near[0].n for r in rows) > 0 for rows in rounds)
    if spare == 400:
        at_home = sum(r.shard == r.near[0].label for r in settled.values())
        assert len(settled) == groups and at_home >= 0.9 * groups
    scratch.close()


def test_every_cut_of_a_shard_fills_it(s):
    rng = np.random.default_rng(9)
    for shards, high, hot in ((7, 30, 0), (13, 9, 150), (40, 6, 1)):
        sizes = rng.integers(1, high, 60).tolist() + [hot] * (hot > 1)
        rows = [doc(i, f"group {g}") for i, g in enumerate(g for g, m in enumerate(sizes) for _ in range(m))]
        got = sharding.shard_documents(s.createDataFrame(rows, SCHEMA), shards=shards).collect()
        count = Counter(r.shard for r in got)
        assert sorted(r.doc_id for r in got) == list(range(len(rows))) and len(count) == shards and max(count.values()) - min(count.values()) <= 1
        places = defaultdict(set)
        for r in got:
            places[rows[r.doc_id][1]].add(r.shard)
        assert sum(len(p) - 1 for p in places.values()) < shards


def test_fewer_rows_than_shards_and_null_texts(s):
    got = sharding.shard_documents(s.createDataFrame([doc(1, "a"), doc(2, "a"), doc(None, None), doc(None, None)], SCHEMA), shards=6).collect()
    assert Counter(r.shard for r in got) == Counter(range(4)) and {(r.size, r.text_crc32) for r in got if r.doc_id is None} == {(16, None)}


# --- op10 --------------------------------------------------------------------------------------------------------------


def test_contamination_equals_brute_force(s, messy, empty):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    items = [(1, " ".join(f"Term{i}" for i in range(20, 45))), (2, "two words"), (3, None), (4, "--"), (5, " ".join(f"term{i}" for i in range(0, 13))), (None, "one"), (6, "a b c d e f"), (7, "zz yy"), (8, "two words")]
    rows = MESSY + [doc(30, "x " + BASE[:200] + " y"), doc(31, " ".join(["a b c d e f"] * 3)), doc(32, BASE + " " + "filler " * 3000)]
    want = []
    for d in rows:
        w, hit, named = split(d[1]), set(), set()
        for i, t in items:
            v = split(t)
            for a in range(max(1, len(v) - 12) if v else 0):
                win = v[a:a + 13]
                for at in range(len(w) - len(win) + 1):
                    if w[at:at + len(win)] == win:
                        hit |= set(range(at, at + len(win)))
                        named |= {i} - {None}
        want.append((d[0], len(w), len(hit), len(named), tuple(sorted(map(str, named))), bool(hit) and 20 * len(hit) >= len(w)))
    docs, bench = s.createDataFrame(rows, SCHEMA), s.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_contamination(docs, bench).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, tuple(r.item_ids), r.contaminated) for r in got), key=repr) == sorted(want, key=repr)
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted((str(r.doc_id) for r in kept.collect())) == sorted(str(w[0]) for w in want if not w[5])
    assert decontaminate.find_contamination(empty, bench).collect() == []
    assert not any(r.contaminated for r in decontaminate.find_contamination(messy, bench.limit(0)).collect())


def test_no_python_in_decontamination(s, messy):
    plan = decontaminate.drop_contaminated(messy, s.createDataFrame([(1, "a b c")], "item_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- the pipeline ------------------------------------------------------------------------------------------------------


def test_rows_apart_from_keys(s):
    docs = s.range(3000).select("id", F.lit(1).alias("key"), F.lit("x").alias("_bits"))
    keys = docs.filter("id % 3 = 0").select(F.xxhash64("id").alias("key"))
    free, asked = spread.apart(docs, keys, F.xxhash64(docs["id"]))
    assert free.columns == docs.columns and free.count() + asked.count() == 3000
    assert free.filter("id % 3 = 0").count() == 0 and asked.count() < 1010
    free, asked = spread.apart(docs, keys.limit(0), F.xxhash64(docs["id"]))
    assert free.count() == 3000 and asked.count() == 0


@pytest.mark.parametrize("kind", ["messy", "empty"])
def test_pipeline_stages_on_odd_rows(s, tables, messy, empty, kind):
    import corpus_pipeline as p

    docs = messy if kind == "messy" else empty
    columns = docs.columns
    for name, stage in p.STAGES:
        before, docs = docs, Scratch(s).write(stage(s, docs, tables.folder))
        if name != "sharding":
            assert docs.columns == columns
    assert docs.count() == before.count()
    if kind == "messy":
        assert docs.count() > 0 and {r.doc_id for r in docs.collect()} <= {r[0] for r in MESSY}


def test_pipeline_stages_broadcast_no_table_that_grows(s, tables, messy, plans, monkeypatch):
    import corpus_pipeline as p

    # a prefix shingle is a row of the benchmark, and broadcast only where those are counted and few
    monkeypatch.setattr(spread, "SMALL_ROWS", -1)
    for _, stage in p.STAGES[:3]:
        plans.clear()
        Scratch(s).write(stage(s, messy, tables.folder), "stage")
        # the kept rows are told apart by a bit map, whose size is set, and then compared by id
        (last,) = plans.pop("stage")
        kinds = set(re.findall(r"(\w+Join) \[(_own)?", last))
        assert kinds == {("BroadcastHashJoin", "_own"), ("SortMergeJoin", "")}
        if "true" in plans:
            assert "SortMergeJoin" in plans["true"][0] and "Broadcast" not in plans["true"][0] + plans["contamination"][0]


def test_pipeline_stages_by_brute_force(s, tables):
    import corpus_pipeline as p

    folder = tables.folder
    docs = tables.documents
    for _, stage in p.STAGES[:-1]:
        assert stage(s, docs, folder).columns == docs.columns
    good = p.classify_quality(s, docs, folder)
    marks = {r.doc_id: r.quality for r in tables.labels.collect()}
    left = {r.doc_id for r in good.collect()}
    assert sum(marks[i] == 1 for i in left if i in marks) >= 0.97 * sum(v == 1 for v in marks.values())
    assert sum(marks[i] == 0 for i in left if i in marks) <= 0.1 * sum(v == 0 for v in marks.values())
    rows = [(r.doc_id, r.text) for r in good.collect()]
    unique = p.drop_near_duplicates(s, good, folder)
    assert sorted(r.doc_id for r in unique.collect()) == sorted(r[0] for r in brute_near(rows, 5, 80) if r[3])
    out = p.run(s, folder)
    count = Counter(r.shard for r in out.collect())
    assert len(count) == 40 and max(count.values()) - min(count.values()) <= 1
