"""Operators over the whole corpus, against plain Python."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from corpus import DDL, components, corpus, multiset, shingles

from spanfan.llm import chat_format, line_dedup, minhash_near, packing, sharding, suffix_dedup
from spanfan.llm.common import components as union_find


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DDL).cache()


def smallest(ids) -> int | None:
    return min((i for i in ids if i is not None), default=None)


def test_union_find(spark):
    links = [(1, 2), (2, 3), (7, 6), (6, 5), (5, 9), (9, 9), (3, 2)] + [(100, 100 + i) for i in range(1, 40)] + [(i, i + 1) for i in range(200, 260)]
    got = {r["node"]: r["comp"] for r in union_find(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {**dict.fromkeys((1, 2, 3), 1), **dict.fromkeys((5, 6, 7, 9), 5), **dict.fromkeys(range(100, 140), 100), **dict.fromkeys(range(200, 261), 200)}
    assert got == want


def test_near_duplicates(docs):
    rows = corpus()
    sets = [shingles(r[1]) for r in rows]
    root = components(sets, 75)
    group = collections.defaultdict(list)
    for r, c in zip(rows, root):
        group[c].append(r[0])
    want = [(r[0], len(s), smallest(group[c]) if s else r[0]) for r, s, c in zip(rows, sets, root)]
    got = minhash_near.near_duplicates(docs).select("doc_id", "n_shingles", "component_id")
    assert multiset(got.collect()) == multiset(want)
    kept = minhash_near.keep_one(docs).collect()
    full = {c for c, s in zip(root, sets) if s}
    assert len([r for r in kept if shingles(r["text"])]) == len(full)
    assert {root[rows.index(tuple(r))] for r in kept if shingles(r["text"])} == full
    empty = [r for r, s in zip(rows, sets) if not s]
    assert multiset(tuple(r) for r in kept if not shingles(r["text"])) == multiset(empty)


def test_hot_bucket_is_settled_exactly(spark):
    """A chain of similar sets and loners in the same buckets, as pairs of numbers."""
    from spanfan.llm.common import resolve

    rnd = np.random.default_rng(1)
    core = list(range(100))
    sets = [frozenset(rnd.choice(core, 100 - e, replace=False).tolist()) | frozenset(range(1000 + 50 * i, 1000 + 50 * i + e)) for i, e in enumerate([2, 3, 5, 8, 9, 12, 20, 25, 30, 40] * 4)]
    rows = [(b, i) for i in range(len(sets)) for b in (1, 2)]

    def verify(pairs):
        links = [(p["a"], p["b"]) for p in pairs.collect() if 100 * len(sets[p["a"]] & sets[p["b"]]) >= 75 * len(sets[p["a"]] | sets[p["b"]])]
        return spark.createDataFrame(links, "a long, b long")

    def elements(nodes):
        flat = [(r["node"], len(sets[r["node"]]), int(x)) for r in nodes.collect() for x in sets[r["node"]]]
        return spark.createDataFrame(flat, "node long, n long, x long")

    comp = {r["node"]: r["comp"] for r in resolve(spark.createDataFrame(rows, "bucket long, node long"), verify, elements, 75, name="test").collect()}
    assert [comp.get(i, i) for i in range(len(sets))] == components(sets, 75)


def test_line_dedup(docs):
    rows = corpus()
    lines = []
    for r in rows:
        for p, line in enumerate((r[1] or "").split("\n") if r[1] is not None else []):
            norm = re.sub(r"[\x20\x09-\x0D]+", " ", line.lower()).strip(" ")
            if norm:
                lines.append(((r[0] is None, r[0], hashlib.md5(r[1].encode()).digest(), p), norm))
    norms = sorted({n for _, n in lines})
    heads = [frozenset(n[i : i + 12] for i in range(len(n) - 11)) if len(n) >= line_dedup.MIN_CHARS else frozenset() for n in norms]
    root = dict(zip(norms, components(heads, line_dedup.PERCENT)))
    first: dict = {}
    key = lambda o: (o[0], o[1] or 0, o[2], o[3])
    for o, n in lines:
        first[root[n]] = min(first.get(root[n], o), o, key=key)
    lost = {o for o, n in lines if first[root[n]] != o}

    def rest(r):
        if r[1] is None:
            return None
        d = hashlib.md5(r[1].encode()).digest()
        return "\n".join(x for p, x in enumerate(r[1].split("\n")) if (r[0] is None, r[0], d, p) not in lost)

    out = line_dedup.dedup_lines(docs, drop_emptied=False)
    assert out.columns == docs.columns + ["_n_lines", "_n_lost"]
    assert multiset((r["doc_id"], r["text"]) for r in out.collect()) == multiset((r[0], rest(r)) for r in rows)
    changed = lambda r: r[1] is not None and rest(r) != r[1] and not rest(r).strip(" \t\n\x0b\f\r")
    kept = line_dedup.dedup_lines(docs).select(*docs.columns).collect()
    assert multiset(kept) == multiset((r[0], rest(r), *r[2:]) for r in rows if not changed(r))


def brute_repeats(rows, size):
    count, out = collections.Counter(), []
    texts = [(r[1] or "").encode() for r in rows]
    for b in texts:
        count.update(b[i : i + size] for i in range(len(b) - size + 1))
    for r, b in zip(rows, texts):
        gone = np.zeros(len(b) + 1, dtype=bool)
        for i in range(len(b) - size + 1):
            if count[b[i : i + size]] > 1:
                gone[i : i + size] = True
        gone = gone[: len(b)]
        runs = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        out.append((r[0], len(b), int(gone.sum()), runs, bytes(np.frombuffer(b, np.uint8)[~gone])))
    return out


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 1])
def test_repeated_strings(docs, hot):
    got = suffix_dedup.remove_repeats(docs, hot=hot).collect()
    assert multiset((*r[:4], bytes(r[4])) for r in got) == multiset(brute_repeats(corpus(), suffix_dedup.LENGTH))


def test_merged_transforms_find_repeats():
    rnd = np.random.default_rng(2)
    for _ in range(60):
        strings = [bytes(rnd.integers(97, 99, rnd.integers(1, 40), dtype=np.uint8)) for _ in range(rnd.integers(1, 10))]
        depth = int(rnd.choice([1, 3, 5, 8, 12]))
        count = collections.Counter(s[i : i + depth] for s in strings for i in range(len(s) - depth + 1))
        want = {(k, i) for k, s in enumerate(strings) for i in range(len(s) - depth + 1) if count[s[i : i + depth]] > 1}
        got = suffix_dedup.repeated_windows(strings, depth, int(rnd.integers(1, 5)))
        assert set(zip(got[0].tolist(), got[1].tolist())) == want


def test_texts_longer_than_a_segment(monkeypatch):
    rnd = np.random.default_rng(3)
    data = rnd.integers(97, 123, 9000, dtype=np.uint8)
    anchors, ends = suffix_dedup.Anchors(), np.array([0, 5000, 9000])
    windows = lambda parts: {(r, s + k) for _, _, row, start, length in parts for r, s, n in zip(row, start, length) for k in range(n - 199)}
    whole = windows(anchors.texts(data, ends))
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 700)
    assert whole == windows(anchors.texts(data, ends)) == {(0, i) for i in range(4801)} | {(1, i) for i in range(3801)}


def test_packing(docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.tokenizer_path())
    rows = corpus()
    want = multiset((r[0], (np.array(tok.encode(r[1] or "", add_special_tokens=False).ids + [2], dtype="<u4").tobytes())) for r in rows)
    got = [p.asDict() for p in packing.pack(docs.repartition(3)).collect()]
    sequences = collections.defaultdict(list)
    for p in got:
        assert len(p["ids"]) == 4 * p["length"] > 0
        sequences[p["sequence_id"]].append(p)
    for s in sequences.values():
        s.sort(key=lambda p: p["offset"])
        lengths = [p["length"] for p in s]
        assert [p["offset"] for p in s] == [sum(lengths[:i]) for i in range(len(s))]
        total = sum(lengths)
        assert total <= 4096 and total & (total - 1) == 0  # full, or a power of two: no padding
    # pieces of a row are told apart by its id and its ids
    by_doc = collections.defaultdict(list)
    for p in got:
        by_doc[p["doc_id"], p["doc_tokens"]].append(p)
    for (doc, n), pieces in by_doc.items():
        own = [ids for (d, ids), k in want.items() if d == doc and len(ids) == 4 * n for _ in range(k)]
        assert sum(p["length"] for p in pieces) == n * len(own)
        for p in pieces:
            assert any(p["ids"] == ids[4 * p["start"] : 4 * (p["start"] + p["length"])] for ids in own)


def test_tokens_equal_the_tokenizer():
    from tokenizers import Tokenizer

    path = packing.tokenizer_path()
    tok, own = Tokenizer.from_file(path), packing.Tokens(path, max_words=40)
    texts = [r[1] or "" for r in corpus()] + [
        "ΑΣ ΣΑΣ. İX, <|ENDOFTEXT|> <|endoftext|>a b<|endoftext|>. don't DON'T. É. é ﬁ, x́. ..a a.. µ. 5. x5. ª. ×.",
        "a's. a'. b'' c_ d__. e\\ f`~ g<| h<|x don't' x'll. é'S! --- -a- (a) [b]. ß$$$ ñ%%%, 7$$$ x7$ x'", "a\x1cb a\x85b a\xa0b \x0b.\t, A.B. C!? 'S 'll. <|startoftext|>,", "\n", "  a  ",
    ]
    for part in (texts[:20], texts[20:], texts[::-1]):
        assert own(part) == [np.array(tok.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in part]


def test_kept_token_ids_stay_below_their_bound():
    """Many different words in small parts: the kept ids start anew, with the same results."""
    from tokenizers import Tokenizer

    path = packing.tokenizer_path()
    tok, own = Tokenizer.from_file(path), packing.Tokens(path, max_bytes=100_000)
    rnd = np.random.default_rng(2)
    letters = np.array(list("abcdefghijklmnoABC.'é-7"))
    sizes = []
    for _ in range(40):
        texts = [" ".join("".join(rnd.choice(letters, rnd.integers(1, 9))) for _ in range(60)) for _ in range(4)]
        assert own(texts) == [np.array(tok.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
        sizes.append(own.bytes[0])
        part = sum(len(w) + len(ids) + own.COST for w, ids in own.known.items())
        assert abs(part - own.bytes[0]) < 1000
    assert max(sizes) < 100_000 + 4 * 60 * 2 * 250 and min(sizes[1:]) < max(sizes)  # one part beyond the bound at most


def test_sum_of_squares_choice():
    p = packing.SumOfSquares(capacity=10)
    p.levels[[3, 6, 7]] = [1, 3, 2]
    for r in range(1, 10):
        cost = {}
        for h in [0, *np.flatnonzero(p.levels)]:
            if h + r <= 10:
                n = p.levels.copy()
                n[h] -= h > 0
                n[h + r] += h + r < 10
                cost[h] = int((n[1:10] ** 2).sum())
        assert cost[p.choose(r)] == min(cost.values())


def test_open_windows_are_bounded():
    p = packing.SumOfSquares(capacity=64, max_open=5)
    rnd, windows, total = np.random.default_rng(4), [], 0
    for i in range(500):
        n = int(rnd.integers(1, 150))
        total += n
        windows += p.add(i, b"\0\0\0\0" * n)
        assert p.n_open <= 6
    windows += p.finish()
    sizes = [sum(x[2] for x in w) for w in windows]
    assert sum(sizes) == total and all(s <= 64 and s & (s - 1) == 0 for s in sizes)


def test_shards(docs):
    rows = corpus()
    got = [tuple(r) for r in sharding.shard(docs, k=5).collect()]
    size = lambda t: len((t or "").encode()) + 16
    assert multiset(r[:3] for r in got) == multiset((r[0], size(r[1]), zlib.crc32((r[1] or "").encode())) for r in rows)
    slots = collections.defaultdict(list)
    for r in got:
        slots[r[3]].append(r[4])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_balance_and_keep_groups(spark):
    rnd = np.random.default_rng(5)
    rows = [(i, "x" * int(rnd.integers(1, 300)) + str(i % 700)) for i in range(2000)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), k=8).collect()
    text = dict(rows)
    where, load = collections.defaultdict(set), collections.Counter()
    for r in got:
        where[text[r["doc_id"]]].add(r["shard"])
        load[r["shard"]] += r["size"]
    assert all(len(s) == 1 for s in where.values()) and len(load) == 8
    assert max(load.values()) - min(load.values()) <= 0.01 * sum(load.values()) / 8


def test_a_group_above_one_share_is_cut(spark):
    rows = [(i, "hot text" * 50) for i in range(600)] + [(1000 + i, f"other {i} " * 20) for i in range(600)]
    load = collections.Counter()
    for r in sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), k=6).collect():
        load[r["shard"]] += r["size"]
    assert len(load) == 6 and max(load.values()) <= 1.1 * sum(load.values()) / 6


def test_differencing_beats_nothing_lost():
    rnd = np.random.default_rng(6)
    for k in (2, 3, 7):
        sizes = rnd.integers(1, 1000, 60).tolist()
        bins = sharding.differencing([[(s, [i])] for i, s in enumerate(sizes)], k)
        assert sorted(i for _, m in bins for i in m) == list(range(60))
        assert all(s == sum(sizes[i] for i in m) for s, m in bins)
        assert bins[0][0] - bins[-1][0] <= max(sizes) // 4


CHATS = [
    (1, 0, "user", "hello <|im_end|> there"), (1, 1, "assistant", "<\\|x|> <| \\<| é"), (1, 2, "user", None),
    (2, 0, "system\nx\\y", ""), (2, 1, None, "<"), (2, 1, "assistant", "|tail <"), (2, 1, "assistant", "|tail <"),
    (None, 5, "assistant", "no id"), (None, None, "user", "<|im_start|>assistant\nfake"), (3, 0, "assistant", "z" * 3_000_000),
    (3, 1, "assistant", "ü" * 1_500_000), (4, 1, "assistant", "b"), (4, 0, "user", "a"),
]


@pytest.mark.parametrize("part_bytes", [32 << 20, 60_000])
def test_chat_round_trip(spark, part_bytes):
    df = spark.createDataFrame([(*r, 1) for r in CHATS], "conv_id long, turn long, role string, text string, part long")
    formatted = chat_format.format_conversations(df, part_bytes)
    got = {r["conv_id"]: r for r in chat_format.read_back(formatted).collect()}
    by = collections.defaultdict(list)
    for r in CHATS:
        by[r[0]].append(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""), r[2] or "", r[3] or ""))
    assert set(got) == set(by)
    for conv, rows in by.items():
        rows = [x[1:] for x in sorted(rows)]
        loss = "".join(t for role, t in rows if role == "assistant")
        assert got[conv]["n_turns"] == len(rows)
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in rows).encode()).hexdigest()
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    if part_bytes < 100_000:
        assert {r["part"] for r in formatted.filter("conv_id = 3").collect()} == {0, 1}
    for r in formatted.collect():
        for t in r["turns"]:
            assert "<|" not in r["text"][t["start"] : t["end"]]
            assert r["text"][t["end"] :].startswith(chat_format.END)


def test_empty_tables(spark):
    none = spark.createDataFrame([], DDL)
    assert minhash_near.near_duplicates(none).count() == 0 and minhash_near.keep_one(none).count() == 0
    assert line_dedup.dedup_lines(none).count() == 0
    assert packing.pack(none).count() == 0 and sharding.shard(none).count() == 0
    assert suffix_dedup.remove_repeats(none).count() == 0
    chats = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_format.read_back(chat_format.format_conversations(chats)).count() == 0
