"""Source divergence, prefix BPE and the conversation trie against brute force, and on odd input."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tableworks.llm import divergence, prefix_bpe, trie
from tableworks.llm.queries import session
from tableworks.llm.scratch import Scratch

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, lang string, source string, term string, group int, slice int, n int, p int, value int, rank int"


@pytest.fixture(scope="module")
def s(spark):
    return session(spark)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- op11 --------------------------------------------------------------------------------------------------------------


def divergence_by_hand(rows, least=10, top=10):
    whole, cells, seen, groups = Counter(), Counter(), defaultdict(set), set()
    for k, (text, lang, source) in enumerate(rows):
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        for term in TERM.findall(lower(text)):
            whole[lang, term] += 1
            cells[lang, source, term] += 1
            seen[lang, term].add(k)
    kept = defaultdict(list)
    for (lang, term), docs in seen.items():
        if len(docs) >= least:
            kept[lang].append(term)
    total = {g: sum(cells[(*g, t)] for t in kept[g[0]]) for g in groups}
    share = lambda n, of, v: 1 + 10**9 * (n + 2) // (of + 2 * v)
    gap = lambda p, q: (p - q) ** 2 // (p + q)
    out = []
    for lang, source in groups:
        terms = kept[lang]
        v, n = len(terms), sum(whole[lang, t] for t in terms)
        mine = {t: share(cells[lang, source, t], total[lang, source], v) for t in terms}
        pairs = [(sum(gap(mine[t], share(cells[lang, o, t], total[lang, o], v)) for t in terms), o) for la, o in groups if la == lang and o != source]
        lone = [(gap(mine[t], share(whole[lang, t], n, v)), t) for t in terms if cells[lang, source, t] and mine[t] > share(whole[lang, t], n, v)]
        for part, found, most in (("pair", pairs, len(pairs)), ("term", lone, top)):
            for k, (value, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]):
                out.append((lang, source, part, item, value, k + 1))
    return sorted(out)


def diverging(s, rows, least=10):
    docs = s.createDataFrame([(k, *r, "x", 1, 2, 3, 4, 5, 6) for k, r in enumerate(rows)], DOCS).repartition(3)
    return sorted(map(tuple, divergence.source_divergence(docs, least_docs=least).collect()))


def test_divergence_equals_brute_force(s):
    rng = random.Random(5)
    words = [f"{w}" for w in ("alpha beta gamma delta Straße été 日本 x y z foo-bar don't A1B2 _ 77 Iİk naïve gap").split(" ")]
    rows = [(" ".join(rng.choices(words, k=rng.randint(0, 30))), rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", "é", None])) for _ in range(300)]
    rows += [(None, "en", "a"), ("", None, None), (" \t\n\x0b", "fr", "only"), ("x " * 50_000, "en", "a"), ("long" * 20_000, "de", "b"), ("no terms 1 2 3".upper(), "it", "p"), ("9 9", "it", "q")]
    rows += [("the same words The-Same", "en", "c")] * 40
    assert diverging(s, rows) == divergence_by_hand(rows)
    assert diverging(s, rows[:60], least=1) == divergence_by_hand(rows[:60], least=1)


def test_divergence_without_documents_or_terms(s):
    assert diverging(s, []) == []
    assert diverging(s, [(None, None, None)]) == []
    assert diverging(s, [("a", "en", "p"), ("b", "en", "q")]) == [("en", "p", "pair", "q", 0, 1), ("en", "q", "pair", "p", 0, 1)]


def test_terms_of_many_slices_are_merged_as_they_stream(monkeypatch):
    monkeypatch.setattr(divergence, "MERGE_ROWS", 3)
    rng = random.Random(2)
    rows = sorted((rng.randint(0, 1), rng.choice("abcde"), rng.randint(1, 3), sorted(rng.sample(range(4), 2))) for _ in range(200))
    batches = []
    for k in range(0, 200, 7):
        la, te, d, g = zip(*rows[k:k + 7])
        flat = np.array([x for groups in g for x in groups])
        times = np.repeat(d, [len(groups) for groups in g])
        cells = divergence.packed_cells(np.array(d), np.array([len(groups) for groups in g]), flat, times)
        batches.append(pa.RecordBatch.from_arrays([pa.array(la, pa.int32()), pa.array(te), cells], ["language", "term", "cells"]).slice(0))
    got = [r for b in divergence._merge_terms(40)(iter(batches)) for r in b.to_pylist()]
    want = {}
    for la, te, d, g in rows:
        at = want.setdefault((la, te), [0, Counter()])
        at[0] += d
        for x in g:
            at[1][x] += d
    want = {k: v for k, v in want.items() if v[0] >= 40}
    assert len(got) == len(want) > 0
    for r in got:
        docs, cells = want[r["language"], r["term"]]
        assert r["docs"] == docs and dict(zip(r["groups"], r["times"])) == dict(cells)


def test_shares_are_exact_beyond_64_bits():
    times, total = np.array([0, 3 * 10**11, 7 * 10**12 + 1]), np.array([5, 10**12 + 7, 9 * 10**12])
    assert divergence.exact_shares(times, total).tolist() == [1 + 10**9 * (a + 2) // b for a, b in zip(times.tolist(), total.tolist())]


# --- op12 --------------------------------------------------------------------------------------------------------------


def _vocabulary():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(_vocabulary())


def odd_texts(n, seed=1):
    rng = random.Random(seed)
    kinds = ["abcdefghij ", "aab", " \n\t\r 　", "aAzZ09'’s t re", "日本語中文漢字かな", "éüßñçøÅ", "😀👍🏽‍️", "<|endoftext|>", "!?.,;:-_=+()[]{}", "١٢٣Ⅷ²", "\x00\x01\x7f\x85\x1c"]
    for _ in range(n):
        parts = [rng.choice(kinds) for _ in range(rng.randint(0, 8))]
        yield "".join(p if p.startswith("<|") and rng.random() < 0.3 else "".join(rng.choices(p, k=rng.randint(1, 12))) for p in parts)


def test_prefix_ids_equal_the_librarys(library):
    bpe = prefix_bpe.PrefixEncoder(_vocabulary())
    for text in [*odd_texts(4000), "a" * 20_000, " " * 9_001 + "x", "日" * 5_000, "=" * 7_001, "xyzzy" * 3_000]:
        ids = library.encode(text, add_special_tokens=False).ids
        packed = bpe.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == ids, text[:80]
        assert bpe.decode(packed) == library.decode(ids, skip_special_tokens=False) == text
    # ids that are no whole characters
    for ids in ([220, 163], [48950, 255, 10], [50256, 187]):
        assert bpe.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids, skip_special_tokens=False)


def test_every_pair_of_some_tokens_stays_apart_as_the_library_has_it(library):
    bpe = prefix_bpe.PrefixEncoder(_vocabulary())
    rng = random.Random(3)
    letters = [k for k in range(50256) if bpe.bytes[k].isalpha()]
    for _ in range(3000):
        a, b = rng.choice(letters), rng.choice(letters)
        want = library.encode((bpe.bytes[a] + bpe.bytes[b]).decode(), add_special_tokens=False).ids == [a, b]
        assert bpe.apart(a, b) == want


def test_long_pieces_take_time_in_proportion(library):
    import time

    bpe = prefix_bpe.PrefixEncoder(_vocabulary())
    bpe.encode("ab" * 1000)
    took = []
    for n in (50_000, 400_000):
        start = time.perf_counter()
        bpe.encode("ab" * n)
        took.append(time.perf_counter() - start)
    assert took[1] < 8 * 4 * took[0]


def test_encode_and_decode_on_odd_rows(s, library):
    texts = [None, "", "  ", "plain words", "<|endoftext|>", "x" * 300_000, "same", "same", *odd_texts(50, 9)]
    rows = [(None if k == 3 else k // 2, t, "n", 1) for k, t in enumerate(texts)]
    docs = s.createDataFrame(rows, "doc_id long, text string, ids_sha256 string, n_tokens int").repartition(3)
    got = Counter(map(tuple, prefix_bpe.encode_and_decode(docs, _vocabulary()).collect()))
    want = Counter()
    for doc, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        packed = np.array(ids, "<u4").tobytes()
        want[doc, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert got == want
    assert prefix_bpe.encode_and_decode(docs.limit(0), _vocabulary(), ids=True).collect() == []
    first = prefix_bpe.encode_and_decode(docs.filter("text = 'plain words'"), _vocabulary(), ids=True).first()
    assert first.ids == library.encode("plain words", add_special_tokens=False).ids


# --- op13 --------------------------------------------------------------------------------------------------------------


def trie_by_hand(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            mark = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[conv].append(((turn is not None, turn or 0), mark, (role, text)))
    own = {c: [t[2] for t in sorted(w)] for c, w in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, w in built.items():
        for d in range(len(w) + 1):
            members[tuple(w[:d])].append(c)
        ends[tuple(w)].append(c)
    kids = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k in members:
        for d in range(len(k) + 1):
            leaves[k[:d]] += kids[k] == 0
            saved[k[:d]] += (len(members[k]) - 1) * (len(k[-1][1].encode()) if k else 0)
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k], hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest()) for k, m in members.items())


CONVERSATIONS = "conv_id long, turn long, role string, text string, depth int, hi int, mark string, k int, bytes int, left int"


def trie_of(s, rows):
    got = trie.conversation_trie(s.createDataFrame([(*r, 1, 2, "m", 3, 4, 5) for r in rows], CONVERSATIONS).repartition(3)).collect()
    return sorted(map(tuple, got))


def test_trie_equals_brute_force(s):
    rng = random.Random(11)
    rows = []
    for c in range(400):
        common = c % 3 == 0
        for k in range(rng.randint(1, 12)):
            text = f"turn {k}" if common and k < 6 else rng.choice(["yes", "no", "é" * 5, ""]) if rng.random() < 0.6 else f"own {c} {k}"
            rows.append((c, k, rng.choice(["user", "assistant"]) if not common else "user", text))
    assert trie_of(s, rows) == trie_by_hand(rows)


def test_trie_of_one_long_conversation_and_its_copies(s):
    rows = [(5 * c, k, "user", f"step {k}") for c in (1, 2, 3) for k in range(1500)]
    rows += [(5 * c, k, "user", f"step {k}") for c in range(4, 40) for k in range(3 + c)]
    assert trie_of(s, rows) == trie_by_hand(rows)


def test_trie_of_odd_rows(s):
    rows = [
        (1, None, None, None), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "user", "b"), (2, 7, "", ""), (3, 1, "user", "x" * 100_000), (None, 1, "user", "lost"),
        (0, 3, "a", "bc"), (0, 4, "ab", "c"), (10**15, 1, "user", "far"), (10**15 + 1, 2, None, "near"), (7, 1, "user", "t"), (8, 1, "user", "t"), (9, 1, "user", "t"),
    ]
    assert trie_of(s, rows) == trie_by_hand(rows)
    assert trie_of(s, []) == [] and trie_of(s, [(None, 1, "user", "lost")]) == []
    # a conversation of which nothing is left after the rebuilding still is a member of the root
    short = [c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0][:3]
    rows = [(c, 1, "user", "gone") for c in short]
    assert trie_of(s, rows) == trie_by_hand(rows) and len(trie_by_hand(rows)) == 1


def test_slot_table_is_minimal_and_tells_strangers():
    rng = np.random.default_rng(4)
    hi, lo = rng.integers(-2**63, 2**63, (2, 5000))
    table = trie.SlotTable(hi, lo)
    assert sorted(table.find(hi, lo).tolist()) == list(range(5000))
    assert (table.find(hi, lo + 1) == -1).all() and (table.find(lo, hi) == -1).all()
    assert trie.SlotTable(hi[:0], lo[:0]).find(hi[:3], lo[:3]).tolist() == [-1] * 3
    with pytest.raises(ValueError):
        trie.SlotTable(np.array([1, 1]), np.array([2, 2]))


def test_clashing_prefix_digests_are_made_anew(s, monkeypatch):
    """The first salt maps every prefix to one digest; the nodes still come out right."""
    real, used = trie._digests, []

    def weak(sums, depth, salt):
        used.append(salt)
        return [k * 0 if salt == 0 else k for k in real(sums, depth, salt)]

    monkeypatch.setattr(trie, "_digests", weak)
    rows = [(5 * c, k, "user", f"{c % 2} {k}") for c in range(4) for k in range(3)]
    assert trie_of(s, rows) == trie_by_hand(rows)
    assert 0 in used and 1 in used


def test_shards_share_tables_without_being_cut(monkeypatch):
    monkeypatch.setattr(trie, "TABLE_NODES", 5)
    # three chains of four nodes, one shard each
    rows = [(s, s, 100 * s + d, 1, 100 * s + d - 1, 1, 7, d, 2, 10) for s in (1, 2, 3) for d in range(1, 5)]
    names = ["shard_hi", "shard_lo", "hi", "lo", "parent_hi", "parent_lo", "conv_id", "depth", "n_convs", "bytes"]
    batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[k:k + 3])], names) for k in range(0, 12, 3)]
    got = {r["hi"]: r for b in trie._tables(iter(batches)) for r in b.to_pylist()}
    assert len(got) == 12
    for shard in (1, 2, 3):
        assert [got[100 * shard + d]["saved_tokens"] for d in range(1, 5)] == [40, 30, 20, 10]
        assert [got[100 * shard + d]["top"] for d in range(1, 5)] == [True, False, False, False]


def test_id_lists_are_hashed_in_pieces(monkeypatch):
    monkeypatch.setattr(trie, "PIECE_CHARS", 12)
    rows = [(1, 1, c) for c in range(95, 130)] + [(1, 2, 7), (2, 1, -3), (2, 1, 4)]
    batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[k:k + 10])], ["hi", "lo", "conv_id"]) for k in range(0, len(rows), 10)]
    pieces = list(trie._id_pieces(iter(batches)))
    assert sum(b.num_rows for b in pieces) > 5
    got = {(r["hi"], r["lo"]): r["ends_sha256"] for b in trie._id_digests(iter(pieces)) for r in b.to_pylist()}
    want = {(1, 1): ",".join(map(str, range(95, 130))), (1, 2): "7", (2, 1): "-3,4"}
    assert got == {k: hashlib.sha256(v.encode()).hexdigest() for k, v in want.items()}


def test_scratch_holds_only_results(s):
    scratch = Scratch(s)
    turns = s.createDataFrame([(1, 1, 0, bytearray(b"m"), 4)], "conv_id long, depth long, left long, mark binary, bytes long")
    trie.prefix_trie(turns, s.createDataFrame([(1, 1)], "conv_id long, length long"), scratch)
    assert len(scratch._paths) == 1
