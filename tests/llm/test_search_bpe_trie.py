"""Ranked search, byte-level BPE and the conversation trie."""

from __future__ import annotations

import base64
import hashlib
import math
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from barscreen.llm import bpe, prefix_trie, search
from barscreen.llm.common import staged
from barscreen.llm.queries import QUERIES, tokenizer_path
from tests.llm.reference import WORD

TERM = re.compile(search.TERM)
ODD = "doc_id long, text string, rank int, score double, mark string, sketch string, ids string, n_terms int"


def term_list(text):
    low = re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or "")
    return TERM.findall(low)


def plain_search(docs, items, k=10):
    """Rows (item_id, rank, doc_id, score) by scoring everything."""
    counted = [(d, Counter(term_list(t))) for d, t in docs]
    sizes = [sum(c.values()) for _, c in counted]
    n_docs, tokens = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for (doc, c), n in zip(counted, sizes, strict=True):
            m = 10 + 90 * n * n_docs // tokens if tokens else 10
            s = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in set(term_list(text)) if c[t]
            )
            if s > 0:
                scores.append((-s, doc is None, doc or 0, doc))
        out += [(item, i + 1, row[3], -row[0]) for i, row in enumerate(sorted(scores, key=lambda r: r[:3])[:k])]
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=repr)


ODD_TEXTS = [
    (1, None), (2, ""), (3, " .,! \n"), (4, "Ünï-cödé wörds wörds"), (5, "same words here " * 3000), (6, "same words here " * 3000),
    (6, "same words here " * 3000), (None, "no id at ALL"), (None, "no id at all"), (8, "a b c d e f g h words"), (9, "A b,c\x7fd{e}"),
    *[(100 + i, f"copy of one text with words number {i % 3}") for i in range(40)],
]
ITEMS = [(1, "words here"), (2, None), (3, "..."), (4, "no id at all, A b c"), (5, "copy copy COPY number 1"), (5, "wörds"), (None, "text"), (7, "nowhere")]


def odd_docs(spark, rows=ODD_TEXTS):
    return spark.createDataFrame([(*r, 1, 1.0, "x", "y", "z", 3) for r in rows], ODD)


def test_search_of_odd_rows(spark, monkeypatch):
    """Nulls, empty and long texts, ties, repeated rows and items, clashing names; several batches."""
    items = spark.createDataFrame([(*i, 5, "x") for i in ITEMS], "item_id long, text string, doc_id int, bound string")
    want = plain_search(ODD_TEXTS, ITEMS)
    assert found(search.search(odd_docs(spark).repartition(3), items)) == want
    monkeypatch.setattr(search, "BATCH_ITEMS", 3)
    assert found(search.search(odd_docs(spark), items)) == want
    assert found(search.search(odd_docs(spark), items, k=2)) == plain_search(ODD_TEXTS, ITEMS, 2)
    assert search.search(odd_docs(spark).limit(0), items).count() == 0
    assert search.search(odd_docs(spark), items.limit(0)).count() == 0


def test_search_matches_plain_scores(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    assert found(QUERIES["op11_ranked_search"](spark, small)) == plain_search(docs, items)


@pytest.fixture
def few_places():
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(search, "PLACES", 128)
        yield


@settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.integers(0, 300), min_size=1, max_size=80), min_size=1, max_size=8), st.integers(1, 400))
def test_bounds_are_never_below_scores(few_places, texts, repeats):
    """With many collisions and counts beyond what a coordinate tells apart."""
    counts = [Counter({b"%d" % t: (t % 7) * repeats + 1 for t in text}) for text in texts]
    sizes = [sum(c.values()) for c in counts]
    batch = search.Batch([sorted(c) for c in counts], 3)
    batch.weigh(len(texts), sum(sizes), {i: sum(t in c for c in counts) for t, i in batch.numbers.items()})
    bounds = batch.bounds([search.sketch(c) for c in counts], sizes)
    for row, c in enumerate(counts):
        for item in range(len(counts)):
            assert bounds[row, item] >= batch.score(c, batch.measure(sizes[row]), item)


def test_search_passes_most_documents_over(spark):
    """The floors that the highest bounds give leave few documents to score exactly."""
    sf = "/root/testdata/sf0.01"
    index = staged(search.sketched(spark.read.parquet(f"{sf}/documents.parquet")), "index")
    _, items = next(search.batches(spark.read.parquet(f"{sf}/benchmark.parquet")))
    batch = search.Batch(items, 10)
    totals = index.selectExpr("count_if(n_terms > 0) AS docs", "sum(n_terms) AS tokens").first()
    batch.weigh(totals.docs, totals.tokens, search.holding(index, batch))
    search._raise_floors(index, batch)
    rows = index.select("sketch", "n_terms").collect()
    bounds = batch.bounds([bytes(r.sketch) for r in rows], [r.n_terms for r in rows])
    scored = (bounds >= np.array(batch.floors)).sum()
    assert 10 * len(items) <= scored < 0.2 * bounds.size


@pytest.fixture(scope="module")
def multi():
    import public_tokenizers
    import tiktoken

    model = bpe.Vocabulary(tokenizer_path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=model.ranks, special_tokens={})
    return model, theirs


def ids(model, texts):
    return [np.frombuffer(i, "<u4").tolist() for i in model.encode(texts)]


def test_bpe_of_every_code_point(multi):
    """Letter, number and blank classes of the two pattern engines are the same."""
    model, theirs = multi
    for lo in range(0, 0x110000, 1 << 14):
        chars = [chr(c) for c in range(lo, lo + (1 << 14)) if not 0xD800 <= c < 0xE000]
        texts = [f"a{c}1{c}{c} {c}x {c}" for c in chars]
        assert ids(model, texts) == [theirs.encode_ordinary(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aabehinst 'é漢🙂\n\t0.<|>")) | st.characters(exclude_categories=["Cs"]), max_size=200))
def test_bpe_is_the_librarys(multi, text):
    model, theirs = multi
    coded = model.encode([text, "", text + text])
    assert [np.frombuffer(c, "<u4").tolist() for c in coded] == [theirs.encode_ordinary(t) for t in (text, "", text + text)]
    assert model.decode(coded[0]) == text.encode()


def test_bpe_of_long_pre_tokens(multi):
    model, theirs = multi
    rng = np.random.default_rng(0)
    letters = "".join(rng.choice(list("etaoinshrdlué"), 300_000))
    texts = [letters, "a" * 200_001, "ab" * 50_000, " " * 70_001, "-=" * 9_999, "\n" * 30_000 + "x"]
    assert ids(model, texts) == [theirs.encode_ordinary(t) for t in texts]
    assert not any(len(k) > bpe.LONGEST for k in model.known)


def plain_bpe(piece, ranks):
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        ranked = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]
        if not ranked:
            return [ranks[p] for p in parts]
        i = min(ranked)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


@settings(max_examples=150, deadline=None)
@given(st.sets(st.text("ab", min_size=2, max_size=5), max_size=20), st.randoms(use_true_random=False), st.lists(st.text("abc", max_size=30), max_size=5))
def test_rank_queue_with_any_order_of_ranks(tmp_path_factory, tokens, random, texts):
    """Also when a merge makes pairs of lower or equal ranks, which trained vocabularies rarely have."""
    more = sorted(tokens)
    random.shuffle(more)
    file = tmp_path_factory.mktemp("ranks") / "own.tiktoken"
    every = [bytes([b]) for b in range(256)] + [t.encode() for t in more]
    file.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(every)))
    model = bpe.Vocabulary(str(file), ".+")
    want = [[model.ranks[t.encode()]] if t.encode() in model.ranks else plain_bpe(t.encode(), model.ranks) for t in texts]
    assert ids(model, texts) == [w if t else [] for w, t in zip(want, texts, strict=True)]
    assert model.queue.lowest() == bpe.NONE and not any(model.queue.words)


def test_bpe_of_odd_rows(spark, multi):
    import public_tokenizers

    path, (model, theirs) = tokenizer_path("byte_bpe_multi_50k.tiktoken"), multi
    docs = odd_docs(spark, [*ODD_TEXTS, (7, "漢" * 30_000), (7, "漢" * 30_000)])
    names = {"ids": "coded", "keep_text": True}
    coded = bpe.encoded(docs, path, public_tokenizers.PATTERN, **names)
    rows = bpe.decoded(coded, path, public_tokenizers.PATTERN, "coded").collect()
    assert len(rows) == docs.count() and rows[0].ids == "z"
    for r in rows:
        assert np.frombuffer(r.coded, "<u4").tolist() == theirs.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()
    assert bpe.encoded(docs.limit(0), path, public_tokenizers.PATTERN, **names).count() == 0


def test_bpe_query(spark, small, multi):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = QUERIES["op12_byte_bpe"](spark, small).collect()
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    for r in rows:
        want = multi[1].encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(want), hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def plain_trie(rows):
    """Nodes of (conv_id, turn, role, text) by every prefix."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, prefix_key(role or "", text or ""), (role or "", text or "")))
    turns = {c: [t[3] for t in sorted(found)] for c, found in turns.items()}
    built = {}
    for c, own in turns.items():
        h = crc32(str(c).encode()) % 4
        built[c] = tuple(turns.get(c - c % 20, [])[:h] + own[h:])
    nodes = defaultdict(list)
    for c, path in built.items():
        for d in range(len(path) + 1):
            nodes[path[:d]].append(c)
    children, under = defaultdict(int), defaultdict(list)
    for p in nodes:
        if p:
            children[p[:-1]] += 1
        for d in range(len(p) + 1):
            under[p[:d]].append(p)
    saved = {p: (len(m) - 1) * len(WORD.findall(p[-1][1])) if p else 0 for p, m in nodes.items()}
    out = []
    for p, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if built[c] == p)
        out.append((
            min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), children[p], sum(not children[x] for x in under[p]),
            sum(saved[x] for x in under[p]), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def prefix_key(role, text):
    """Equal turns go by the digest of role and text."""
    digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
    return digest + f"{len(WORD.findall(text)):08X}"


def nodes_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "conv_id long, turn long, role string, text string, depth int, path string, key string")


ODD_TURNS = [
    (1, 0, "user", "hi there"), (1, 1, None, None), (1, None, "system", ""), (2, 0, "user", "hi there"), (2, 0, "user", "hi there"),
    (2, 0, "assistant", "other at the same turn"), (None, 0, "user", "no conversation"), (20, 5, "user", "long " * 40_000), (21, 0, "user", "x"),
    (22, 0, "a", "b:c"), (23, 0, "ab", ":c"), (-7, 0, "user", "negative"), (-20, 1, "user", "x"),
    *[(1000 + i, t, "user", f"same {t}") for i in range(60) for t in range(4)],
    *[(2000, t, "user", f"deep {t}") for t in range(300)], *[(2001 + i, t, "user", f"deep {t}") for i in (0, 18) for t in range(250)],
]


@pytest.mark.parametrize("shard_turns", [1, 7, 100_000])
def test_trie_of_odd_rows(spark, monkeypatch, shard_turns):
    """Nulls, ties, repeated rows, a deep conversation and copies, over one shard or very many."""
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    df = conversations(spark, ODD_TURNS)
    want = plain_trie([r for r in ODD_TURNS if r[0] is None or r[0] >= 0])
    positive = df.where("conv_id >= 0 OR conv_id IS NULL")
    got = prefix_trie.trie(prefix_trie.paths(positive), max(shard_turns, 60))
    assert nodes_of(got) == want
    if shard_turns > 60:
        assert prefix_trie.trie(prefix_trie.paths(df)).where("depth = 0").first().n_convs == 71
        assert prefix_trie.trie(prefix_trie.paths(df.limit(0))).count() == 0


def test_trie_merges_nodes_of_shards(spark):
    """Few distinct turns, so that most nodes lie on the edge of some of the shards."""
    rows = [(c, t, "r", "ab"[(c >> t) % 2] * (1 + (c * t) % 2)) for c in range(300) for t in range(c % 9)]
    rows += [(c, 0, "r", "alone") for c in range(300, 320)]
    found = prefix_trie.paths(conversations(spark, rows))
    want = plain_trie(rows)
    assert nodes_of(prefix_trie.trie(found, 40)) == want == nodes_of(prefix_trie.trie(found))


def test_ternary_tree():
    paths = sorted({tuple(c % k for k in range(2, 2 + c % 5)) for c in range(90)})
    tree = prefix_trie.TernaryTree()
    order = list(prefix_trie.middles(len(paths)))
    assert sorted(order) == list(range(len(paths))) and order[0] == len(paths) // 2
    for i in order:
        tree.insert(list(paths[i]), 1, i, i)
    walked = []
    for node in tree.in_order():
        path = []
        at = node
        while at:
            path.append(tree.label[at])
            at = tree.parent[at]
        walked.append(tuple(reversed(path)))
    assert walked == sorted({p[:d] for p in paths for d in range(len(p) + 1)})
    assert [tree.along(list(p))[-1] for p in paths] == [tree.end.index(i) for i in range(len(paths))]


def test_merges_where_lower_ranks_come_up(tmp_path):
    """Ranks dealt at random: merging makes pairs of lower rank than the one in hand, and pairs of a
    rank that was left half done."""
    import base64
    import random

    from barscreen.llm import bpe

    def plainly(model, piece):
        ids = [model.bytes[b] for b in piece]
        while True:
            made = [(model.pairs.get(a << 32 | b, 1 << 40), i) for i, (a, b) in enumerate(zip(ids, ids[1:]))]
            if not made or min(made)[0] == 1 << 40:
                return ids
            rank, i = min(made)
            ids[i : i + 2] = [rank]

    deal = random.Random(7)
    for turn in range(20):
        tokens = {bytes(deal.choices(b"abc", k=deal.randint(2, 5))) for _ in range(60)}
        tokens = sorted(tokens, key=lambda _: deal.random())
        path = tmp_path / f"{turn}.tiktoken"
        every = [bytes([b]) for b in range(256)] + tokens
        path.write_text("".join(f"{base64.b64encode(t).decode()} {i}\n" for i, t in enumerate(every)))
        model = bpe.Vocabulary(str(path), r"\S+")
        pieces = list({bytes(deal.choices(b"abc", k=deal.randint(1, 40))) for _ in range(60)})
        assert model.merged(pieces) == [plainly(model, p) for p in pieces]
        assert not any(model.queue.buckets) and not model.queue.top
