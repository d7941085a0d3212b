"""Language identification by cross-parsing entropy.

Labelled text of each language is turned into a suffix automaton. A text is parsed against each
of them: the longest match from where the last phrase ended is the next phrase. The language
that needs the fewest phrases, each weighed by what it costs to point into that language's
training text (log2 of its length), wins.

The automata are small (a documented number of characters per language, of a documented number of
languages) and held as arrays of transitions laid over each other, so that a task parses thousands
of lanes at once with numpy. A lane is a
stretch of LANE letters of a text; every lane starts a phrase, in every language alike, and all
lanes of the whole text are parsed.
"""

from __future__ import annotations

import logging
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barscreen.llm.common import add_columns, bucket, held

#: Bounds of the fit: per language, documents drawn and characters kept; languages learned.
FIT_DOCS, FIT_CHARS, FIT_LANGS = 60, 60_000, 256
LANE = 512
NONE = "und"
_OTHER = re.compile(r"[\W\d_]+")
_LOG = logging.getLogger(__name__)


def letters(text: str) -> str:
    """Lower-cased text in which every run of other characters than letters is one space."""
    kept = _OTHER.sub(" ", text.lower()).strip()
    return kept if any(map(str.isalpha, kept)) else ""


def automaton(text: str) -> tuple[list[dict[str, int]], int]:
    """Transitions of the suffix automaton of `text`: state -> letter -> state, from state 0."""
    moves: list[dict[str, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in text:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                twin = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return moves, last


def phrases(text: str, moves: list[dict[str, int]]) -> int:
    """Phrases of the cross-parse; a letter the automaton lacks is a phrase of its own."""
    state = count = 0
    inside = False
    for c in text:
        after = moves[state].get(c) if inside else None
        if after is None:
            count += 1
            after = moves[0].get(c)
            inside = after is not None
            state = after or 0
        else:
            state = after
    return count


def displaced(moves: list[dict[str, int]], codes: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, owner, target): the transitions of an automaton laid over each other in one array.

    State s has its row at place[s], a place of its own; its transition by a letter of code c lies
    at place[s] + c, where `owner` names the row that the entry belongs to and `target` the place
    of the next state. Rows are put where their entries meet free ones, those with most entries
    first, so the arrays are about as long as there are transitions, whatever the alphabet.
    """
    width = max(codes.values(), default=0) + 1
    rows = [sorted([codes[c] for c in out]) for out in moves]
    sizes = np.array([len(r) for r in rows])
    taken = bytearray(width + 2 * int(sizes.sum()) + len(moves))
    place = np.full(len(moves), -1, np.int64)
    used: set[int] = set()
    low = width
    for state in np.argsort(-sizes, kind="stable")[: int((sizes > 1).sum())].tolist():
        row, at, tries = rows[state], low, 0
        while True:
            at = taken.find(0, at)
            if at < 0 or at + width >= len(taken):
                at = len(taken) if at < 0 else at
                taken.extend(bytes(len(taken) + width))
                continue
            base = at - row[0]
            if base not in used and not any([taken[base + c] for c in row]):
                break
            at, tries = at + 1, tries + 1
        if tries > 8:  # the places before are nearly full
            low = at
        used.add(base)
        place[state] = base
        for c in row:
            taken[base + c] = 1
    # Rows of one entry, and the last state's of none, fill the gaps, all at once as far as their
    # places differ.
    left = np.flatnonzero(sizes < 2)
    entry = np.array([rows[s][0] if rows[s] else 0 for s in left], np.int64)
    free = np.flatnonzero(np.frombuffer(taken, np.uint8)[width:] == 0) + width
    known, end, stuck = np.fromiter(used, np.int64, len(used)), len(taken), False
    while len(left):
        if stuck or len(free) < len(left):
            free = np.concatenate([np.arange(end, end + 2 * len(left)), free])
            end += 2 * len(left)
        base = free[: len(left)] - entry
        _, first = np.unique(base, return_index=True)
        good = np.zeros(len(left), bool)
        good[first] = ~np.isin(base[first], known)
        place[left[good]] = base[good]
        known = np.concatenate([known, base[good]])
        # A place that did not suit is tried again by another row.
        tried = free[: len(left)][~good]
        free = np.concatenate([free[len(left) :], tried])
        left, entry, stuck = left[~good], entry[~good], not good.any()
    size = int(place.max()) + 2 * width
    owner, target = np.full(size, -1, np.int32), np.zeros(size, np.int32)
    states = np.repeat(np.arange(len(moves)), sizes)
    after = np.array([out[c] for out in moves for c in sorted(out, key=codes.__getitem__)], np.int64)
    at = place[states] + np.array([c for r in rows for c in r], np.int64)
    owner[at], target[at] = place[states], place[after]
    return place, owner, target


class Parser:
    """Automata of the languages as arrays that are as long as their transitions.

    Letters have codes over all languages, 0 is any other letter. A language's memory grows with
    its training text only, not with the letters of the others.
    """

    def __init__(self, texts: dict[str, str]) -> None:
        self.langs = list(texts)
        alphabet = sorted(set().union(*texts.values())) if texts else []
        codes = {c: i for i, c in enumerate(alphabet, 1)}
        self.codes = np.zeros(0x110000, np.int32)
        self.codes[[ord(c) for c in alphabet]] = np.arange(1, len(alphabet) + 1)
        self.tables, self.costs = [], []
        for lang in self.langs:
            moves, _ = automaton(texts[lang])
            place, owner, target = displaced(moves, codes)
            # The state after a first letter; no row lies at the last place, where a phrase ends.
            nowhere = len(owner) - len(alphabet) - 1
            begun = np.full(len(alphabet) + 1, nowhere, np.int32)
            for c, after in moves[0].items():
                begun[codes[c]] = place[after]
            self.tables.append((owner, target, begun, nowhere))
            self.costs.append(np.log2(len(texts[lang]) + 2))

    def counts(self, texts: list[str]) -> np.ndarray:
        """Cost of each text (rows) in each language (columns): phrases times bits a phrase."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        lanes = -(-sizes // LANE)
        total = int(lanes.sum())
        owner = np.repeat(np.arange(len(texts)), lanes)
        first = np.cumsum(lanes) - lanes
        within = np.arange(total) - np.repeat(first, lanes)
        starts = np.repeat(np.cumsum(sizes) - sizes, lanes) + within * LANE
        lengths = np.minimum(LANE, np.repeat(sizes, lanes) - within * LANE)
        order = np.argsort(-lengths, kind="stable")
        starts, lengths, owner = starts[order], lengths[order], owner[order]
        joined = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        coded = self.codes[joined]
        active = np.searchsorted(-lengths, -np.arange(LANE), side="left")
        out = np.zeros((len(texts), len(self.langs)))
        for k, (row, target, begun, nowhere) in enumerate(self.tables):
            state = np.full(total, nowhere, np.int32)
            found = np.zeros(total, np.int32)
            for i in range(LANE):
                n = active[i]
                if not n:
                    break
                c = coded[starts[:n] + i]
                at = state[:n] + c
                ended = row[at] != state[:n]
                found[:n] += ended
                state[:n] = np.where(ended, begun[c], target[at])  # a new phrase starts with this letter
            out[:, k] = np.bincount(owner, found, len(texts)) * self.costs[k]
        return out


def parser(texts: dict[str, str]) -> Parser:
    """The parser of these training texts, built once in a worker process."""
    key = zlib.crc32(repr(texts).encode("utf-8", "surrogatepass"))
    return held(("parser", key), lambda: Parser(texts))


def fit(
    labelled: DataFrame, docs_per_lang: int = FIT_DOCS, chars_per_lang: int = FIT_CHARS, most: int = FIT_LANGS,
) -> dict[str, str]:
    """Training text per language from (doc_id, text, lang), the language of most documents
    first: a draw by hash of `doc_id`, bounded by both parameters, every language cut to about
    the same length. Of more than `most` label values those of most documents are learned, so that
    a column full of mistakes does not fill the workers; a warning says so.

    The row number per language is limited before the shuffle, so no task gets more than
    `docs_per_lang` rows from each task before it. Null and letterless texts are passed over.
    """
    ordered = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "text")
    usable = labelled.where("lang is not null and text rlike '\\\\p{L}'")
    langs = [r.lang for r in usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most + 1).collect()]
    if len(langs) > most:
        _LOG.warning("only the %d languages of most documents are learned", most)
        langs = langs[:most]
    drawn = (
        usable.where(F.col("lang").isin(langs)).select("doc_id", "lang", F.substring("text", 1, chars_per_lang).alias("text"))
        .withColumn("_n", F.row_number().over(ordered))
        .where(F.col("_n") <= docs_per_lang)
        .orderBy("lang", "_n")
    )
    texts: dict[str, list[str]] = {lang: [] for lang in langs}
    for row in drawn.select("lang", "text").collect():
        texts[row.lang].append(letters(row.text))
    joined = {lang: " ".join(parts)[:chars_per_lang] for lang, parts in texts.items()}
    return {lang: text for lang, text in joined.items() if text}


def predicted(
    docs: DataFrame, texts: dict[str, str], text: str = "text",
    names: tuple[str, str] = ("lang_pred", "score"), keep_text: bool = True,
) -> DataFrame:
    """Every column of `docs` and (lang_pred, score); whole texts, no shuffle.

    Ties go to the language learned from more documents. The score is the winner's share when each language
    weighs two to the minus its extra bits a letter, sharpened by the text's length; `und` with
    score 0 is given to null and letterless texts, and to all if nothing was learned.
    """

    def make(given: list[str | None]) -> list[pa.Array]:
        model = parser(texts)
        clean = [letters(t) if t else "" for t in given]
        langs, scores = [NONE] * len(given), [0.0] * len(given)
        rows = [i for i, t in enumerate(clean) if t]
        if rows and model.langs:
            bits = model.counts([clean[i] for i in rows])
            sizes = np.array([len(clean[i]) for i in rows])[:, None]
            extra = (bits - bits.min(axis=1, keepdims=True)) / sizes * np.minimum(sizes, 64)
            weight = np.exp2(-np.minimum(extra, 1000))
            best = weight.argmax(axis=1)
            for i, b, w in zip(rows, best, weight, strict=True):
                langs[i], scores[i] = model.langs[b], float(w[b] / w.sum())
        return [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]

    return add_columns(docs, text, f"{names[0]} string, {names[1]} double", make, keep_text)


def held_out(doc_id: str = "doc_id") -> Column:
    return bucket(F.col(doc_id), 5) == 0
