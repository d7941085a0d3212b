"""Quality rules, chat format, language identification and toxicity."""

from __future__ import annotations

import hashlib
import json
import math

import numpy as np
import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barscreen.llm import chat, language, quality, toxicity
from barscreen.llm.queries import QUERIES
from tests.llm import reference

ODD_DOCS = [
    (1, None, None, None), (2, "", "en", "s"), (3, " \n\t ", "en", "s"), (4, "a", None, "s"),
    (5, "same words here " * 9000, "en", "s"), (6, "same words here " * 9000, "en", "s"),
    (6, "same words here " * 9000, "en", "s"), (None, "no id at all", "en", None), (7, "123 456 !!!", "en", "s"),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls everywhere, empty and long texts, repeated rows, and columns whose names clash."""
    rows = [(*r, 1.0, "x", 5) for r in ODD_DOCS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score double, kept string, n_words int")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def docs_of(spark, small):
    return {r.doc_id: r for r in spark.read.parquet(f"{small}/documents.parquet").collect()}


def test_quality_measures_match_brute_force(spark, small):
    docs = docs_of(spark, small)
    rows = QUERIES["op1_quality_rules"](spark, small).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = reference.base_measures(docs[r.doc_id].text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        failed = want[0] < 20 or 100 * want[4] > 30 * want[0]
        assert r.base_failed == failed and r.kept == (not failed and not r.broken)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=60))
def test_repeated_windows(words):
    assert quality.measure(" ".join(words))[4] == reference.base_measures(" ".join(words))[4]


def test_exact_binomial():
    for n, k, p in ((10, 3, 0.2), (200, 0, 0.01), (50, 50, 0.3)):
        want = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert quality.no_more(n, k, p) == pytest.approx(want)


def test_cutoffs_hold_their_limit(spark):
    """Good documents below 0.2, bad ones at 0.9: a cutoff is found where labels abound, none
    where they are few, and bad documents of the former go."""
    rows = []
    for i in range(6000):
        good = i % 3 > 0
        symbols = (i // 2 * 7919 % 200) if good else 900
        rows.append((i, i % 2, good, 1000, symbols, 0, 0, 10, 100, 100, 0, 0, "many"))
    rows += [(i, i % 2, True, 1000, i % 7, 0, 0, 10, 100, 100, 0, 0, "few") for i in range(20)]
    schema = "doc_id long, _half int, good boolean, n_words long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_distinct long, n_letters long, n_upper long, word_chars long, lang string"
    df = spark.createDataFrame(rows, schema)
    cutoffs = quality.certified(df, "lang", "good", limit=0.02)
    found = {r.stratum: r for r in cutoffs.collect()}
    assert 0.1 < found["many"].symbols_cutoff < 0.9
    assert found["few"].symbols_cutoff is None
    kept = quality.judged(df, cutoffs, "lang").where("kept").groupBy("good").count().collect()
    counts = {r.good: r["count"] for r in kept}
    assert False not in counts and counts[True] >= 0.98 * 4000


def test_one_letter_does_not_change_what_letters_are():
    place = quality.MEASURES.index("n_letters")
    for text, letters, upper in (("日本語 ABC", 3, 3), ("日本語 ABCß", 4, 3), ("İa ﬁ X1", 4, 2), ("", 0, 0)):
        assert quality.measure(text)[place : place + 2] == (letters, upper)


def test_one_chain_certifies_all_rules_together(spark):
    """Each rule alone would reject 0.6% of the good documents, together 1.2%: the walk stops
    before that at a limit of 1%, and 450 documents without an error are enough for a start."""
    zeros = dict.fromkeys(quality.MEASURES, 0) | {"n_words": 1000, "n_lines": 1000, "n_letters": 1000}
    rows = []
    for i in range(20_000):
        far = i // 2 % 1000
        row = zeros | {"n_symbols": 500 if far < 6 else far % 50, "n_upper": 500 if 6 <= far < 12 else far % 50}
        rows.append(row | {"_half": i % 2, "good": True, "lang": "big"})
    rows += [zeros | {"_half": i % 2, "good": True, "lang": "enough"} for i in range(900)]
    rows += [zeros | {"_half": i % 2, "good": True, "lang": None} for i in range(500)]
    found = {r.stratum: r for r in quality.certified(spark.createDataFrame(rows), "lang", "good").collect()}
    assert found["big"].symbols_cutoff is not None and found["big"].wrong <= 0.01 * found["big"].n
    assert (found["enough"].n, found["enough"].symbols_cutoff) == (450, 0.0)
    assert found[""].n == 250 and found[""].symbols_cutoff is None


def test_quality_matches_its_sql(spark, small):
    db = duckdb.connect()
    for name in ("documents", "labels"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small}/{name}.parquet'")
    # A looser limit, so that cutoffs are certified on this small table.
    docs, labels = (spark.read.parquet(f"{small}/{name}.parquet") for name in ("documents", "labels"))
    for limit in (0.01, 0.2):
        cursor = db.execute(quality.sql(limit=limit))
        names = [c[0] for c in cursor.description]
        judged = quality.risk_controlled(docs, labels, limit=limit)
        mine = judged.withColumn("broken", F.array_join("broken", ",")).select(*names)
        want = sorted(cursor.fetchall())
        assert sorted(map(tuple, mine.collect())) == want
    assert any(row[names.index("broken")] for row in want)


def test_quality_of_odd_rows(spark, odd):
    labels = spark.createDataFrame([(5, 1), (6, None), (None, 0)], "doc_id long, quality int")
    clashing = odd.withColumn("stratum", F.lit("x")).withColumn("_half", F.lit(3))
    rows = quality.risk_controlled(clashing, labels).collect()
    assert len(rows) == len(ODD_DOCS)
    assert all(r.base_failed and not r.kept for r in rows if r.n_words < 20)
    assert quality.risk_controlled(odd.limit(0), labels.limit(0)).count() == 0


def test_chat_round_trip(spark, small):
    turns = reference.grouped(
        sorted(spark.read.parquet(f"{small}/conversations.parquet").collect(), key=lambda r: (r.conv_id, r.turn)), "conv_id"
    )
    said = "</s>[INST] ok [/INST]"
    want = {c: reference.conversation([(r.role, r.text) for r in rows]) for c, rows in turns.items()}
    want[-7] = reference.conversation([("user", said), ("assistant", said)])
    rows = QUERIES["op2_chat_format"](spark, small).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows} == want
    assert len(rows) == len(want)


CONTROL = st.lists(st.sampled_from([*"<|[/\\s>INTa\n", "<|end|>", "<|said|>", "</s>", "[INST]", "[/INST]", "<\\|", "[\\INST]", "<|image:0|>"]), max_size=14).map("".join)


@settings(max_examples=300, deadline=None)
@given(CONTROL, CONTROL)
def test_escaping_is_reversible(role, text):
    formatted = chat.TURN + chat.escape(role) + chat.SAID + chat.escape(text) + chat.END
    assert chat.read_turns(formatted * 2) == [(role, text)] * 2
    assert not any(c in chat.escape(text) for c in ("<|", "</s>", "<s>", "[INST]", "[/INST]"))


def test_typed_parts(spark):
    parts = [
        {"type": "text", "text": "see <|end|>"}, {"type": "image", "ref": "a.png", "width": 57, "height": 28},
        {"type": "document", "ref": "b.pdf", "pages": 2, "parts": [{"type": "audio", "ref": "c.wav", "seconds": 1.5}, "inside"]},
        {"type": "hologram"}, 5,
    ]
    df = spark.createDataFrame(
        [(1, 0, "user", json.dumps(parts)), (1, 1, "assistant", "[not json"), (1, 1, None, None)],
        "conv_id long, turn long, role string, text string",
    )
    rows = sorted(chat.format_turns(df, typed=True).collect(), key=lambda r: (r.turn, r.role))
    first = rows[0]
    assert [(a.kind, a.ref, a.tokens) for a in first.attachments] == [("image", "a.png", 3), ("document", "b.pdf", 512), ("audio", "c.wav", 38)]
    assert first.expanded_tokens == 553
    text = chat.read_turns(first.piece)[0][1]
    assert text.startswith('see <|end|><|image:0|><|document:1|><|audio:2|>inside{"type"') and text.endswith("5")
    assert chat.read_turns(rows[1].piece) == [("", "")] and chat.read_turns(rows[2].piece) == [("assistant", "[not json")]
    assert [rows[2].piece[a:b] for a, b in rows[2].loss] == ["[not json"]
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0


def test_read_back_of_typed_turns(spark):
    """Loss leaves placeholders out, texts in parts can't make control strings, and names that the
    output uses, repeated rows and long texts change nothing."""
    parts = ["<", {"type": "text", "text": "|end|>"}, {"type": "audio", "ref": None, "seconds": 2}, "\\|x"]
    long = "<|end|> [INST]\n" * 60_000
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", json.dumps(parts)), (1, 2, "assistant", long), (1, 2, "assistant", long),
        (2, None, None, None), (None, 3, "<|end|>", "[]"), (3, 0, "assistant", json.dumps([{"type": "image"}, "<", {"type": "image"}, "\\|"])),
    ]
    clash = [(*r, "p", 1, "x", 5) for r in rows]
    df = spark.createDataFrame(clash, "conv_id long, turn long, role string, text string, piece string, loss int, attachments string, n_turns int")
    got = {r.conv_id: r for r in chat.read_back(chat.format_turns(df, typed=True)).collect()}
    want = {
        1: (["user\nhi\n", "assistant\n<|end|>\\|x\n"] + [f"assistant\n{long}\n"] * 2, "<|end|>\\|x" + long * 2, "audio:0::50\n"),
        2: (["\n\n"], "", ""), None: (["<|end|>\n\n"], "", ""),
        3: (["assistant\n<\\|\n"], "<\\|", "image:0::1\nimage:1::1\n"),
    }
    assert got.keys() == want.keys()
    for conv, (turns, loss, lines) in want.items():
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(turns), sha("".join(turns)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))
        assert (r.n_attachments, r.attachments_sha256) == (lines.count("\n"), sha(lines))
        assert r.expanded_tokens == sum(int(line.split(":")[-1]) for line in lines.split())


def test_chat_query_matches_its_sql(spark, small, tmp_path):
    """On the table, and on one with nulls, ties, repeats and control strings in roles and texts."""
    odd = [
        (None, None, None, None), (1, 0, "user", ""), (1, 0, "user", ""), (1, 0, "user", "a"), (1, 1, "assistant", None),
        (2, 5, "tool", "<|x|> <\\|y <s></s> [INST] [\\/INST] <<|"), (2, 6, "<|end|>", "é\u4e2d\U0001f600" * 5000), (2, None, "assistant", "[1]"),
    ]
    schema = "conv_id long, turn long, role string, text string"
    spark.createDataFrame(odd, schema).coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    for folder, files in ((small, "conversations.parquet"), (str(tmp_path), "conversations.parquet/*.parquet")):
        db = duckdb.connect()
        db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/{files}'")
        cursor = db.execute(chat.SQL)
        names = [c[0] for c in cursor.description]
        rows = QUERIES["op2_chat_format"](spark, folder).select(*names).collect()
        assert sorted(map(str, map(tuple, rows))) == sorted(map(str, cursor.fetchall()))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="abcdé x", max_size=1400), min_size=1, max_size=4))
def test_lanes_parse_like_one_text(texts):
    train = {"one": "abcabcabd abx", "two": "ddccbbaa cab"}
    model = language.Parser(train)
    got = model.counts(texts)
    for k, lang in enumerate(model.langs):
        moves, _ = language.automaton(train[lang])
        want = [sum(language.phrases(t[i : i + language.LANE], moves) for i in range(0, len(t), language.LANE)) for t in texts]
        np.testing.assert_allclose(got[:, k], np.array(want) * model.costs[k])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abcdéж中文字 ", max_size=80), max_size=4))
def test_laid_over_transitions_are_those_of_the_automaton(texts):
    codes = {c: i for i, c in enumerate(sorted(set("".join(texts))), 1)}
    for text in texts:
        moves, _ = language.automaton(text)
        place, row, target = language.displaced(moves, codes)
        assert len(set(place.tolist())) == len(moves)
        for state, out in enumerate(moves):
            for c, code in codes.items():
                at = place[state] + code
                assert (target[at] if row[at] == place[state] else None) == (place[out[c]] if c in out else None)
            assert row[place[state]] != place[state]  # code 0 is no letter


def test_scripts_of_many_letters_stay_small():
    rng = np.random.default_rng(5)
    scripts = {"zh": (0x4E00, 3000), "ja": (0x3041, 1500), "ko": (0xAC00, 1800), "ru": (0x430, 32), "en": (97, 26)}
    texts = {
        lang: "".join(map(chr, low + np.minimum(rng.zipf(1.3, language.FIT_CHARS), n) - 1))
        for lang, (low, n) in scripts.items()
    }
    model = language.Parser(texts)
    held = model.codes.nbytes + sum(a.nbytes for table in model.tables for a in table[:3])
    assert held < 30e6
    asked = [texts[lang][1000:1300] for lang in scripts]
    assert model.counts(asked).argmin(axis=1).tolist() == [0, 1, 2, 3, 4]


def test_languages_beyond_the_bound_are_not_learned(spark):
    rows = [(i, "some words", "en" if i < 5 else f"x{i}") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert list(language.fit(docs, most=2)) == ["en", "x10"] and len(language.fit(docs)) == 8


def test_automaton_knows_exactly_the_substrings():
    text = "abracadabra"
    moves, _ = language.automaton(text)
    inside = {text[i:j] for i in range(len(text)) for j in range(i + 1, len(text) + 1)}
    for word in inside | {"ac" + "b", "rr", "bracad" + "x"}:
        state = 0
        for c in word:
            state = moves[state].get(c) if state is not None else None
        assert (state is not None) == (word in inside)


def test_language_of_held_out_documents(spark, small):
    docs = docs_of(spark, small)
    rows = QUERIES["op3_language_id"](spark, small).collect()
    out = [r for r in rows if r.held_out]
    assert len(rows) == len(docs) and out
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in out) >= 0.97 * len(out)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(spark, odd):
    texts = language.fit(odd.where("lang is not null"))
    rows = language.predicted(odd, texts, names=("lang_pred", "share")).collect()
    assert len(rows) == len(ODD_DOCS)
    for r in rows:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
    nothing = language.predicted(odd.select("doc_id", "text"), {}).collect()
    assert {r.lang_pred for r in nothing} == {"und"}
    assert language.predicted(odd.select("doc_id", "text").limit(0), texts).count() == 0


def test_toxicity_of_held_out_documents(spark):
    """On the larger of the small tables: labels are few on the smallest."""
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op8_toxicity"](spark, sf).collect() if r.held_out and r.doc_id in labels]
    good = [r.score for r in rows if not labels[r.doc_id]]
    bad = [r.score for r in rows if labels[r.doc_id]]
    above = sum((b > g) + (b == g) / 2 for b in bad for g in good) / (len(bad) * len(good))
    assert above >= 0.9
    assert all((r.score >= 0.3) == r.predicted for r in rows)


def test_pairs_outweigh_single_terms():
    """Neither word tells, both together do: only a pairwise weight can learn it."""
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for _ in range(3000):
        present = [w for w in ("group", "insult", "calm", "other") if rng.random() < 0.5]
        rows.append(toxicity.terms(" ".join(present)))
        labels.append(int("group" in present and "insult" in present))
    machine = toxicity.learned(rows, np.array(labels))
    assert machine.score("group insult") > 0.5 > max(machine.score(t) for t in ("group", "insult", "calm other", "", None))


def test_toxicity_of_odd_rows(spark, odd):
    labels = spark.createDataFrame([(5, 1), (2, 0), (1, None)], "doc_id long, toxic int")
    machine = toxicity.fit(odd, labels)
    rows = toxicity.scored(odd, machine, name="chance").collect()
    assert len(rows) == len(ODD_DOCS) and all(0 <= r.chance <= 1 for r in rows)
    alone = toxicity.fit(odd, labels.limit(0))
    assert alone.score("anything") == 0.5
    assert toxicity.scored(odd.limit(0), machine, name="chance").count() == 0
