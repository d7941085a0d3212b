"""Packing, mixing, near-duplicates, URL reputation, WARC derivatives and the pipeline."""

from __future__ import annotations

import glob
import gzip
import hashlib
import html
import re
import time
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from barscreen.llm import components, language, mixing, neighbours, packing, reputation, simhash, toxicity, warc
from barscreen.llm.common import staged
from barscreen.llm.queries import ORACLES, QUERIES, tokenizer_path
from tests.llm import reference
from tests.llm.test_texts import ODD_DOCS, odd  # noqa: F401
from tools.check import TABLES, rows_of


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, small, name):
    import duckdb

    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    df = QUERIES[name](spark, small)
    cursor = db.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(columns, cursor.fetchall()) == rows_of(df.columns, [tuple(r) for r in df.collect()])


def check_packing(rows, texts):
    """Pieces of {doc_id: text}: every id once and in order, sequences gapless, no padding."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    for doc_id, pieces in reference.grouped(rows, "doc_id").items():
        ids = [*tokenizer.encode(texts[doc_id] or "", add_special_tokens=False).ids, 0]
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert zlib.crc32(np.array(ids[at : at + p.length], "<u4").tobytes()) == p.ids_crc32
            at += p.length
        assert at == len(ids)
    assert {r.doc_id for r in rows} == set(texts)
    for pieces in reference.grouped(rows, "sequence_id").values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024 and at & (at - 1) == 0


def test_packing_is_whole(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    check_packing(QUERIES["op4_hilbert_packing"](spark, small).collect(), texts)


def test_packing_of_odd_rows(spark, odd):  # noqa: F811
    rows = packing.packed(odd, tokenizer_path()).collect()
    for doc_id, text, *_ in ODD_DOCS:
        own = [r for r in rows if r.doc_id == doc_id]
        assert sum(r.length for r in own) == own[0].doc_tokens * sum(d[0] == doc_id for d in ODD_DOCS)
        assert text or own[0].doc_tokens == 1
    assert packing.packed(odd.limit(0), tokenizer_path()).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([*"ab'sé9 \n\t\r.,!\u00a0\u2003\u3000\x1c\x85漢<|>", "<|endoftext|>"]), max_size=40).map("".join))
def test_fast_encoding_is_the_tokenizers(text):
    from tokenizers import Tokenizer

    model = packing.encoder(tokenizer_path())
    plain = Tokenizer.from_file(tokenizer_path())
    assert np.frombuffer(model.encode([text])[0], model.kind).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_hilbert_curve_steps_to_neighbours():
    side = np.arange(8)
    cells = np.stack(np.meshgrid(side, side, side), -1).reshape(-1, 3)
    place = packing.hilbert(cells, bits=3)
    assert sorted(place) == list(range(512))
    walk = cells[np.argsort(place)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_bounded_raking_meets_targets(spark):
    """Raking without the bound puts small cells far above all their tokens."""
    rows = [("a", "en", "x", 900), ("a", "de", "x", 60), ("b", "en", "x", 200), ("b", "de", "x", 80), ("a", "en", "y", 90), ("b", "de", "y", 30), ("b", "en", "y", 40), ("c", "en", "x", 5)]
    cells = staged(spark.createDataFrame(rows, "source string, lang string, topic string, tokens long"), "cells")
    budget = 0.5 * sum(r[3] for r in rows)
    given_ = {"source": {"a": 0.6, "b": 0.3, "c": 0.1}, "lang": {"en": 0.8, "de": 0.2}, "topic": {"x": 0.85, "y": 0.15}}
    found = mixing.bounded(cells, budget, given_).collect()
    assert all(0 < r.p <= 1 for r in found)
    kept = {m: {v: sum(r.p * r.tokens for r in found if r[m] == v) for v in given_[m]} for m in given_}
    # Source c has 5 tokens; a and b share the rest of its target.
    left = budget - 5
    want = {"source": {"a": left * 2 / 3, "b": left / 3, "c": 5}, "lang": {"en": 0.8 * budget, "de": 0.2 * budget}, "topic": {"x": 0.85 * budget, "y": 0.15 * budget}}
    for m in given_:
        assert kept[m] == pytest.approx(want[m], abs=2e-3 * budget)


def test_mixing_of_odd_rows(spark, odd):  # noqa: F811
    rows = mixing.mixed(odd, share=1.0)
    assert rows.columns[: len(odd.columns)] == odd.columns
    assert 0 < rows.count() <= len(ODD_DOCS)
    assert mixing.mixed(odd.limit(0)).count() == 0


def test_simhash_matches_brute_force(spark, small):
    docs = {r.doc_id: reference.simhash(r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    want = reference.components(docs, lambda a, b: (docs[a] ^ docs[b]).bit_count() <= 4)
    rows = QUERIES["op10_simhash_near_dedup"](spark, small).collect()
    assert {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in rows} == {i: (docs[i], want[i]) for i in docs}


@pytest.mark.parametrize("node_rows", [2_000, 20, 5])
def test_trie_join_in_crowded_nodes(spark, node_rows):
    """Fingerprints around a few centres, so that nodes are descended and cut in pieces."""
    rng = np.random.default_rng(node_rows)
    values = set()
    for centre in rng.integers(0, 1 << 63, 6, dtype=np.int64).tolist():
        for _ in range(60):
            value = centre
            for bit in rng.integers(0, 64, rng.integers(0, 9)).tolist():
                value ^= 1 << bit
            values.add(value)
    values = sorted(values)
    want = reference.components(values, lambda a, b: (a ^ b).bit_count() <= 4)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    fps = staged(spark.createDataFrame(signed, "fp long"), "fps")
    joined = {r.node % (1 << 64): r.root % (1 << 64) for r in components.connected(simhash.links(fps, node_rows)).collect()}
    groups = {}
    for v in values:
        groups.setdefault(joined.get(v, v), set()).add(v)
    truth = {}
    for v in values:
        truth.setdefault(want[v], set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, truth.values()))


def test_one_of_each_group_stays(spark, odd):  # noqa: F811
    rows = simhash.keep_one(odd).collect()
    assert sorted((r.doc_id or 0) for r in rows) == [0, 1, 4, 5, 7]
    assert simhash.keep_one(odd.limit(0)).count() == 0
    near = simhash.near_duplicates(odd).collect()
    assert len(near) == len(ODD_DOCS)
    assert {r.component_id for r in near if r.doc_id in (1, 2, 3)} == {1}


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(100)] + [(5000, 5000)]
    found = components.connected(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(found) == 301 and len({r.root for r in found}) == 2


def planted_vectors():
    rng = np.random.default_rng(5)
    rows = [rng.normal(size=24) for _ in range(300)]
    for size in (2, 3, 7, 60):
        centre = rng.normal(size=24)
        rows += [centre + rng.normal(size=24) * 0.2 for _ in range(size)]
    # Two tight crowds that are linked with each other by a few vectors.
    one = rng.normal(size=24)
    two = one + rng.normal(size=24) * 0.42
    rows += [one + rng.normal(size=24) * 0.001 for _ in range(40)] + [two + rng.normal(size=24) * 0.001 for _ in range(40)]
    rows += [rows[-1].copy(), rows[3].copy(), rows[3].copy()]
    return rows


def test_links_of_vectors_match_brute_force(spark):
    rows = planted_vectors()
    data = [(i, [float(x) for x in v], "label") for i, v in enumerate(rows)]
    odd_ones = [(9001, None, "x"), (9002, [0.0] * 24, "x"), (9003, [float("nan")] * 24, "x"), (9004, [1.0, None], "x"), (9005, [], "x"), (9006, [float("inf")] + [1.0] * 23, "x")]
    df = spark.createDataFrame(data + odd_ones, "vec_id long, embedding array<double>, n_links string")
    found = {r.vec_id: r for r in neighbours.near_vectors(df).collect()}
    v = np.array([r[1] for r in data])
    near = (v @ v.T) / np.sqrt((v * v).sum(1)[:, None] * (v * v).sum(1)[None]) >= 0.9
    want = reference.components(range(len(v)), lambda a, b: near[a, b])
    assert len(found) == len(data) + len(odd_ones)
    for i in range(len(v)):
        assert (found[i].n_links, found[i].component_id) == (near[i].sum() - 1, want[i])
        assert found[i].kept == (want[i] == i)
    for i, *_ in odd_ones:
        assert found[i].n_links == 0 and found[i].component_id == i and found[i].kept
    assert neighbours.near_vectors(df.limit(0)).count() == 0


def test_vectors_of_any_size_and_rounding(spark):
    """A pair that one-byte rounding moves from 0.91 to 0.69, squares outside the range of doubles,
    different lengths, and rows of no or one id."""
    wide = np.array([1.0] + [0.004] * 3000)
    other = np.concatenate([wide[:1], -wide[1:]])
    rows = [
        (1, wide.tolist()), (2, other.tolist()), (3, [1e300, 1e300]), (4, [1e300, 1.1e300]),
        (5, [0.0, 0.0, 1e-300, 1e-300]), (6, [0.0, 0.0, 2e-300, 2e-300]), (7, [0.0] * 5 + [1.0]), (7, [0.0] * 5 + [1.0]),
        (None, [0.0] * 6 + [1.0]), (None, [0.0] * 6 + [1.0]), (8, [0.0] * 7 + [5e-324]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in neighbours.near_vectors(df).collect()]
    assert sorted(found, key=str) == sorted([
        (1, 1, 1, True), (2, 1, 1, False), (3, 1, 3, True), (4, 1, 3, False), (5, 1, 5, True), (6, 1, 5, False),
        (7, 1, 7, True), (7, 1, 7, True), (None, 1, None, True), (None, 1, None, True), (8, 0, 8, True),
    ], key=str)


def test_one_link_between_two_crowds(spark):
    """Lists of both ends of the only bridge are full of nearer members of their own crowds."""
    rng = np.random.default_rng(11)
    turns = np.radians([0.0] * 200 + [18.2, 41.3] + [59.5] * 200)
    v = np.zeros((len(turns), 24))
    v[:, 0], v[:, 1] = np.cos(turns), np.sin(turns)
    v += rng.normal(size=v.shape) * 1e-4
    near = (v @ v.T) / np.sqrt((v * v).sum(1)[:, None] * (v * v).sum(1)[None]) >= 0.9
    assert near[200, 201] and near[:201, 201:].sum() == 1
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    found = {r.vec_id: (r.n_links, r.component_id) for r in neighbours.near_vectors(df).collect()}
    assert found == {i: (near[i].sum() - 1, 0) for i in range(len(v))}


def test_audit_sees_sparse_and_indirect_losses(spark, monkeypatch):
    """A link lost inside a component and the only links of a table with few, then no way out."""
    rng = np.random.default_rng(23)
    v = rng.normal(size=(1_500, 24))
    for i in range(0, 6, 2):
        v[i + 1] = v[i] + rng.normal(size=24) * 0.05
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    _, nodes = neighbours.nodes_of(df)
    at = {r.low: r.id for r in nodes.collect()}
    none = spark.createDataFrame([], "a long, b long")
    assert neighbours.audit(none, nodes, 0.9) == 0
    three = nodes.where(F.col("low").isin(0, 1, 2))
    chain = spark.createDataFrame([(at[0], at[1]), (at[1], at[2])], "a long, b long")
    assert neighbours.audit(chain, three, -1.0) == pytest.approx(2 / 3)
    monkeypatch.setattr(neighbours, "exact_links", lambda *_: none)
    monkeypatch.setattr(neighbours, "EXTRA_ROUNDS", 0)
    with pytest.raises(RuntimeError, match="recall"):
        neighbours.near_vectors(df)


def test_suffixes_by_rule_and_by_table(spark):
    hosts = spark.createDataFrame(
        [(h,) for h in ("a.b.co.nz", "x.ac.uk", "co.kr", "www.site.com", "go.com", "10.0.0.1:80", "", "a.b.town.example.jp", "x.io:8080")], "host string"
    )
    got = {r.host: (r.suffix, r.domain) for r in reputation.levels(hosts).collect()}
    assert got == {
        "a.b.co.nz": ("co.nz", "b.co.nz"), "x.ac.uk": ("ac.uk", "x.ac.uk"), "co.kr": ("co.kr", "co.kr"),
        "www.site.com": ("com", "site.com"), "go.com": ("com", "go.com"), "10.0.0.1:80": ("10.0.0.1", "10.0.0.1"),
        "": ("", ""), "a.b.town.example.jp": ("jp", "example.jp"), "x.io:8080": ("io", "x.io"),
    }
    table = spark.createDataFrame([("jp",), ("example.jp",), ("town.example.jp",), ("town.example.jp",), (None,), ("com",)], "suffix string")
    got = {r.host: (r.suffix, r.domain) for r in reputation.levels(hosts, table).collect()}
    assert got["a.b.town.example.jp"] == ("town.example.jp", "b.town.example.jp")
    assert got["a.b.co.nz"] == ("nz", "co.nz") and got["www.site.com"] == ("com", "site.com")
    assert got["10.0.0.1:80"] == ("10.0.0.1", "10.0.0.1") and len(got) == 9


def test_registered_reputation_blocks_bad_hosts(spark, tmp_path):
    """The registered query and its SQL on pages with planted hosts: a bad one is blocked, as is
    its unseen neighbour under a bad domain's many hosts; what a rule allows and good hosts stay."""
    import duckdb

    pages, labels = [], []
    for h, (host, n, bad) in enumerate((
        ("spam.shop.co.nz", 300, 290), ("fine.edu", 300, 3), ("few.org", 2, 2), ("spam.shop.com", 300, 295),
        ("good.ac.nz", 300, 6), *((f"h{i}.farm.net", 40, 39) for i in range(12)),
        *((f"site{i}.org", 50, i % 3) for i in range(60)),
    )):
        for i in range(n):
            pages.append((h * 1000 + i, f"http://{host}/p{i}", ""))
            labels.append((h * 1000 + i, int(i >= bad), 0))
    pages.append((99_999, "http://new.farm.net/x", ""))
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    df = QUERIES["op7_url_reputation"](spark, str(tmp_path))
    rows = df.collect()
    verdict = {r.host: (r.rule, r.verdict) for r in rows}
    assert verdict["spam.shop.co.nz"] == (None, "block") and verdict["h3.farm.net"] == (None, "block")
    assert verdict["fine.edu"] == verdict["good.ac.nz"] == (None, "allow")
    assert verdict["new.farm.net"] == (None, "block") and verdict["few.org"] == (None, "allow")
    assert verdict["spam.shop.com"] == ("com/", "allow")
    db = duckdb.connect()
    for t in ("pages", "labels"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    cursor = db.execute(ORACLES["op7_url_reputation"])
    columns = [d[0] for d in cursor.description]
    assert rows_of(columns, cursor.fetchall()) == rows_of(df.columns, [tuple(r) for r in rows])


def test_reputation_of_odd_urls(spark):
    urls = ["http://A.Example.com/en/x?q=/fr/#f", "https://www.example.com/en/", "nothing", None, "x://a.net/es/", "x://net", "x://b.net:80/fr/a", "x://1.2.3.4/", "x:///en/"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(0, urls[0], "h")], "page_id long, url string, verdict string")
    bad = spark.createDataFrame([(1, True), (2, None), (None, True)], "page_id long, bad boolean")
    rules = spark.createDataFrame([("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block")], "rule_host string, rule_path string, verdict string")
    rows = sorted(reputation.judged(pages, bad, rules).collect(), key=lambda r: r.page_id)
    assert len(rows) == 10
    got = [(r.host, r.path, r.rule, r.verdict) for r in rows[1:]]
    assert got[0] == ("a.example.com", "/en/x", "example.com/en/", "block")
    assert got[1] == ("www.example.com", "/en/", "www.example.com/en/", "allow")
    assert got[2][:3] == got[3][:3] == ("", "", None)
    assert got[4] == ("a.net", "/es/", "net/es/", "block") and got[5][:3] == ("net", "", None)
    assert got[6][0] == "b.net:80" and got[8][:2] == ("", "/en/")
    assert reputation.judged(pages.limit(0), bad.limit(0), rules.limit(0)).count() == 0


def test_bad_hosts_are_blocked(spark):
    pages = spark.createDataFrame([(i, f"x://{'bad' if i % 2 else 'fine'}{i % 10}.org/p") for i in range(400)], "page_id long, url string")
    bad = pages.select("page_id", (F.col("page_id") % 2 == 1).alias("bad"))
    rules = spark.createDataFrame([], "rule_host string, rule_path string, verdict string")
    rows = reputation.judged(pages, bad, rules).collect()
    assert all((r.verdict == "block") == r.host.startswith("bad") for r in rows)


def parsed(data: bytes):
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        header = dict(line.split(": ", 1) for line in lines[1:])
        size = int(header["Content-Length"])
        block = data[end + 4 : end + 4 + size]
        assert lines[0] == "WARC/1.1" and data[end + 4 + size : end + 8 + size] == b"\r\n\r\n"
        yield header, block
        at = end + 8 + size


def test_warc_files_round_trip(spark, tmp_path):
    page = '<html lang="en"><head><title>A &amp; b</title></head><body><!-- x --><p>One <b>two</b></p><script>no</script><a href="/u">é</a></body></html>'
    pages = spark.createDataFrame([(1, "http://a/", page, "z"), (2, None, None, "z"), (2, None, None, "z"), (3, "http://b/", "", "z")], "page_id long, url string, html string, block string")
    responses = warc.responses(pages)
    made = warc.derivatives(responses)
    assert warc.derivatives(warc.responses(pages.limit(0))).count() == 0
    warc.write(made, str(tmp_path / "w"))
    records = [r for f in glob.glob(f"{tmp_path}/w/*.gz") for r in parsed(gzip.open(f).read())]
    assert len(records) == 8
    ids = {r.record_id: r for r in responses.collect()}
    texts = {}
    for header, block in records:
        assert header["WARC-Block-Digest"] == "sha256:" + hashlib.sha256(block).hexdigest()
        source = ids[header["WARC-Refers-To"]]
        assert header["X-Refers-To-Payload-Digest"] == source.payload_digest and "text/html" in header["X-Source-HTTP-Header"]
        texts[source.page_id, header["WARC-Type"]] = block.decode(), header
    assert texts[1, "conversion"][0] == "One two\né"
    assert "title: A & b\r\nlanguage: en\r\n" in texts[1, "metadata"][0] and "outlink: /u\r\n" in texts[1, "metadata"][0]
    assert f"conversion: {texts[1, 'conversion'][1]['WARC-Record-ID']}" in texts[1, "metadata"][0]
    assert texts[2, "conversion"][0] == texts[3, "conversion"][0] == ""


OPENERS = ["<!--", "<script", "<script>", "<style>", "<head>", "<", "<p", "<p ", "<title>", "<html lang='", "<a href='", '<a href="', "<a ", "<meta charset ", "&#", "&amp", "</script ", " \n", "-->"]


def test_pages_of_openers_take_linear_time(spark):
    """A megabyte of each opener, never closed, in seconds, here and in the comparison SQL."""
    import duckdb

    rows = [(i, "http://x/", o * (1_000_000 // len(o))) for i, o in enumerate(OPENERS)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    start = time.time()
    made = {(r.page_id, r.record_type): r.block_digest for r in warc.derivatives(warc.responses(pages)).collect()}
    assert time.time() - start < 60
    db = duckdb.connect()
    db.register("pages", pages.toPandas())
    start = time.time()
    cursor = db.execute(warc.SQL)
    names = [d[0] for d in cursor.description]
    theirs = [dict(zip(names, r, strict=True)) for r in cursor.fetchall()]
    assert time.time() - start < 60
    assert {(r["page_id"], r["record_type"]): r["block_digest"] for r in theirs} == made


def test_entities_quotes_and_odd_pages(spark):
    named = "caf&eacute; &#8212; &copy; &notanentity; &amp;lt; &#x1F600;&#128; &#0;&#xD800;&#99999999; &lt;b&gt; a & b &amp"
    page = f"""<html class=x lang='de'><head><title>T&eacute;st &amp; one</title><body class="m"><p>{named}</p>
<a href='/one?a=1&amp;b=2'>x</a><a class=k href=/two>y</a><a href = "/three">z</a><a name=n>w</a><a href="">e</a><!-- never closed <p>gone"""
    rows = [(1, "u", page, "b", "t", 1), (2, "u", None, "b", "t", 2), (3, None, "<p>plain", "b", "t", 3), (3, None, "<p>plain", "b", "t", 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, block string, date string, record_id int")
    made = warc.derivatives(warc.responses(pages)).collect()
    assert len(made) == 8
    block = {(r.page_id, r.record_type): r.block for r in made}
    want = "café — © &notanentity; &lt; 😀€ \ufffd\ufffd&#99999999; <b> a & b &amp"
    assert block[1, "conversion"].split("\n")[0] == want
    meta = block[1, "metadata"].split("\r\n")
    assert "title: Tést & one" in meta and "language: de" in meta and "outlink-count: 3" in meta
    assert [m for m in meta if m.startswith("outlink: ")] == ["outlink: /one?a=1&b=2", "outlink: /two", "outlink: /three"]
    assert "gone" not in block[1, "conversion"] and block[3, "conversion"] == "plain" and block[2, "conversion"] == ""


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["&", "#", "x", ";", "&amp;", "&eacute;", "&#233;", "&#x2014;", "&nope;", "&CounterClockwiseContourIntegral;", "a", " ", "&lt;", "&#150;"]), max_size=12).map("".join), min_size=1, max_size=30))
def test_entities_are_the_standard_librarys(spark, texts):
    """For entities with their semicolon; without it they stay here."""
    own = re.compile(warc.ENTITY)
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", warc.decoded(F.col("t")).alias("d")).collect()
    for r in rows:
        assert r.d == own.sub(lambda m: html.unescape(m[0]) if m[0] != "&nope;" else m[0], r.t)


def test_scores_keep_the_labels_rate_whatever_is_drawn(spark):
    """One document in ten is toxic; nothing in the texts tells which."""
    docs = spark.range(4_000).select(F.col("id").alias("doc_id"), F.lit("some words").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 10 == 0).cast("int").alias("toxic"))
    for draws in ({1: 4_000, 0: 4_000}, {1: 300, 0: 500}, {1: 4_000, 0: 500}):
        assert toxicity.fit(docs, labels, draws).score("some words") == pytest.approx(0.1, abs=0.01)


def test_pipeline_stage_by_stage(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, small), name)
        rows = docs.collect()
        assert docs.columns == columns and {r.doc_id: r for r in rows}.items() <= before.items()
        after = {r.doc_id for r in rows}
        assert len(rows) == len(after) > 0
        if name == "simhash_near_dedup":
            prints = {i: reference.simhash(r.text) for i, r in before.items()}
            want = reference.components(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
            assert after == set(want.values())
        if name == "mixing":
            assert 0.2 < sum(len((r.text or "").split()) for r in rows) / sum(len((r.text or "").split()) for r in before.values()) < 0.8
        before = {r.doc_id: r for r in rows}
    packed = staged(corpus_pipeline.pack(spark, docs, small), "packing").collect()
    check_packing(packed, {i: r.text for i, r in before.items()})


def test_pipeline_models_against_plain_sums(spark, small):
    """The first two stages' decisions, from sums over all pairs of terms and letter-by-letter
    parses of each document."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = docs.collect()
    labels = spark.read.parquet(f"{small}/labels.parquet").where(~toxicity.held_out())
    machine = toxicity.fit(docs, labels)
    toxic = set()
    for r in rows:
        present = [i for t in toxicity.terms(r.text).tolist() for i in [machine.index.get(t)] if i is not None]
        raw = machine.bias + sum(machine.weights[i] for i in present)
        raw += sum(float(machine.factors[i] @ machine.factors[j]) for n, i in enumerate(present) for j in present[n + 1 :])
        if 1 / (1 + np.exp(-raw)) >= corpus_pipeline.TOXIC:
            toxic.add(r.doc_id)
    clean = staged(corpus_pipeline.drop_toxic(spark, docs, small), "clean")
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in rows} - toxic

    texts = language.fit(clean.where(~language.held_out()))
    made = {lang: (language.automaton(t)[0], np.log2(len(t) + 2)) for lang, t in texts.items()}
    known = set()
    for r in clean.collect():
        text = language.letters(r.text or "")
        lanes = [text[i : i + language.LANE] for i in range(0, len(text), language.LANE)]
        bits = np.array([sum(language.phrases(t, moves) for t in lanes) * cost for moves, cost in made.values()])
        weight = np.exp2(-(bits - bits.min()) / max(1, len(text)) * min(len(text), 64))
        short = len(r.text or "") < corpus_pipeline.JUDGED
        if text and (short or weight.max() / weight.sum() >= corpus_pipeline.LANGUAGE_SHARE):
            known.add(r.doc_id)
    assert {r.doc_id for r in corpus_pipeline.known_language(spark, clean, small).collect()} == known


def test_short_texts_that_tie_stay(spark, small):
    """A letter that all languages know alike is no reason to drop a document; no letters are."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    tied = [(-1, "a"), (-2, "re"), (-3, "?! 12"), (-4, ""), (-5, None)]
    rows = spark.createDataFrame(tied, "doc_id long, text string")
    every = docs.unionByName(rows, allowMissingColumns=True)
    kept = corpus_pipeline.known_language(spark, every, small).where("doc_id < 0").collect()
    assert sorted(r.doc_id for r in kept) == [-2, -1]


def test_pipeline_of_odd_rows(spark, odd, tmp_path):  # noqa: F811
    labels = spark.createDataFrame([(5, 1), (2, 0)], "doc_id long, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for rows in (odd, odd.limit(0)):
        docs = rows
        for name, stage in corpus_pipeline.STAGES:
            docs = staged(stage(spark, docs, str(tmp_path)), name)
        assert docs.count() >= 0
