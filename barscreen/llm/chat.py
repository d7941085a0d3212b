"""Chat formatting with typed content parts.

A turn's content is plain text or a JSON list of parts. A visitor walks the parts in order and
flattens them into one text with a placeholder for each attachment, while it records the
attachment's reference and the number of tokens that the placeholder expands to:

    {"type": "text", "text": ...}
    {"type": "image", "ref": ..., "width": ..., "height": ...}
    {"type": "audio", "ref": ..., "seconds": ...}
    {"type": "document", "ref": ..., "pages": ..., "parts": [...]}

Control strings inside a text (the template's own and those of other common templates) get a
backslash after their first character; reading takes one away again, so any text comes back.
Texts that follow each other without an attachment between them are escaped as one.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barscreen.llm.common import joined_schema

# Fixed values of the template.
TURN, SAID, END = "<|turn|>", "<|said|>", "<|end|>"
KINDS = ("image", "audio", "document")
# Start, backslashes, rest: of `<|`, `<s>`, `</s>`, `[INST]`, `[/INST]`.
_PLAIN = re.compile(r"(<(?=\\*(?:\||/?s>))|\[(?=\\*/?INST\]))")
_ESCAPED = re.compile(r"(<(?=\\+(?:\||/?s>))|\[(?=\\+/?INST\]))\\")
_TURN = re.compile(re.escape(TURN) + r"(.*?)" + re.escape(SAID) + r"(.*?)" + re.escape(END), re.DOTALL)
_PLACE = re.compile(r"(<\|(?:" + "|".join(KINDS) + r"):\d+\|>)")

PIECES = (
    "role string, piece string, loss array<struct<start int, end int>>, expanded_tokens long,"
    " attachments array<struct<position int, kind string, ref string, tokens long>>"
)


DIGESTS = (
    "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long,"
    " n_attachments long, attachments_sha256 string, expanded_tokens long"
)


def escape(text: str) -> str:
    return _PLAIN.sub(r"\1\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def _amount(part: dict, name: str, least: float = 0) -> float:
    value = part.get(name)
    number = isinstance(value, (int, float)) and not isinstance(value, bool) and math.isfinite(value)
    return max(least, value) if number else least


class PartVisitor:
    """Flattens the parts of one turn. `patch`, `per_second` and `per_page` set how many tokens
    an attachment expands to; sizes that are missing or not numbers count as the least."""

    def __init__(self, patch: int = 28, per_second: float = 25, per_page: int = 256) -> None:
        self.patch, self.per_second, self.per_page = patch, per_second, per_page
        self.said: list[str] = [""]  # texts before, between and after the attachments
        self.found: list[dict] = []

    def visit(self, part: object) -> None:
        kind = part.get("type") if isinstance(part, dict) else None
        if isinstance(part, str):
            self.said[-1] += part
        elif kind == "text":
            self.said[-1] += str(part.get("text") or "")
        elif kind in KINDS:
            getattr(self, f"visit_{kind}")(part)
        else:  # an unknown part stays readable
            self.said[-1] += json.dumps(part, ensure_ascii=False)

    def visit_image(self, part: dict) -> None:
        across, down = (math.ceil(_amount(part, side, 1) / self.patch) for side in ("width", "height"))
        self.attach("image", part, across * down)

    def visit_audio(self, part: dict) -> None:
        self.attach("audio", part, math.ceil(_amount(part, "seconds") * self.per_second))

    def visit_document(self, part: dict) -> None:
        self.attach("document", part, int(_amount(part, "pages", 1)) * self.per_page)
        inner = part.get("parts")
        for each in inner if isinstance(inner, list) else ():
            self.visit(each)

    def attach(self, kind: str, part: dict, tokens: int) -> None:
        position = len(self.found)
        self.said.append("")
        ref = part.get("ref")
        self.found.append({"position": position, "kind": kind, "ref": None if ref is None else str(ref), "tokens": tokens})


def flatten(content: str | None, typed: bool) -> tuple[str, list[tuple[int, int]], list[dict]]:
    """Escaped text with placeholders, where in it texts start and end, and the attachments in
    order. Typed content that is no JSON list is taken as plain text."""
    visitor = PartVisitor()
    parts: object = None
    if typed and content:
        try:
            parts = json.loads(content)
        except ValueError:
            parts = None
    for part in parts if isinstance(parts, list) else [content or ""]:
        visitor.visit(part)
    out, spans, size = [], [], 0
    for i, said in enumerate(map(escape, visitor.said)):
        if i:
            out.append(f"<|{visitor.found[i - 1]['kind']}:{i - 1}|>")
            size += len(out[-1])
        if said:
            spans.append((size, size + len(said)))
            out.append(said)
            size += len(said)
    return "".join(out), spans, visitor.found


def format_turns(conversations: DataFrame, typed: bool = False) -> DataFrame:
    """One row (conv_id, turn, role, piece, ...) per turn of (conv_id, turn, role, text).

    A conversation is the concatenation of its pieces by turn. `loss` marks, in code points of the
    piece, what an assistant turn is trained on: its texts without placeholders (none of other turns).
    Null text and role are empty, null turns come first, repeated turns stay and are ordered by
    role and text. Other columns are left out. Rows are formatted where they lie: no shuffle.
    """
    need = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), "text")
    schema = joined_schema(need.select("conv_id", "turn"), PIECES)
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    kinds = pa.list_(pa.struct([("position", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles = batch.column("role").to_pylist()
            pieces, losses, tokens, found = [], [], [], []
            for role, content in zip(roles, batch.column("text").to_pylist(), strict=True):
                body, texts, attachments = flatten(content, typed)
                head = TURN + escape(role) + SAID
                pieces.append(head + body + END)
                trained = texts if role == "assistant" else ()
                losses.append([{"start": len(head) + a, "end": len(head) + b} for a, b in trained])
                tokens.append(sum(a["tokens"] for a in attachments))
                found.append(attachments)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"), batch.column("turn"), batch.column("role"),
                    pa.array(pieces, pa.string()), pa.array(losses, spans),
                    pa.array(tokens, pa.int64()), pa.array(found, kinds),
                ],
                names=schema.names,
            )

    return need.mapInArrow(run, schema)


def in_order(pieces: DataFrame) -> DataFrame:
    """Each conversation's pieces together and by turn; the one shuffle of the format."""
    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "piece")


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted text. Placeholders stay as they are."""
    return [(unescape(role), "".join(map(_read, _PLACE.split(text)))) for role, text in _TURN.findall(formatted)]


def _read(part: str) -> str:
    """A text between placeholders as it was; a placeholder as it is."""
    return part if _PLACE.fullmatch(part) else unescape(part)


def _texts(formatted: str) -> tuple[list[tuple[str, str]], list[str]]:
    """(role, text without placeholders) of each turn, and the placeholders in order."""
    turns, places = [], []
    for role, body in _TURN.findall(formatted):
        parts = _PLACE.split(body)
        turns.append((unescape(role), "".join(map(unescape, parts[::2]))))
        places += parts[1::2]
    return turns, places


def attached(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with each text made a JSON list of typed parts.

    The rows have no attachments of their own, so theirs are derived: what a user says comes with
    an image whose sides depend on the text's length, what an assistant says is followed by its
    audio at 16 characters a second, other turns are a document of 2,000 characters a page that
    holds the text.
    """
    size = F.length(F.coalesce("text", F.lit("")))
    said = F.struct(F.lit("text").alias("type"), F.coalesce("text", F.lit("")).alias("text"))
    ref = F.concat_ws("/", F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.coalesce(F.col("turn").cast("string"), F.lit("")))

    def listed(*parts: Column) -> Column:
        return F.concat(F.lit("["), F.concat_ws(",", *(F.to_json(p) for p in parts)), F.lit("]"))

    image = F.struct(F.lit("image").alias("type"), ref.alias("ref"), (size % 1000).alias("width"), (size % 700).alias("height"))
    audio = F.struct(F.lit("audio").alias("type"), ref.alias("ref"), (size / 16).alias("seconds"))
    pages = F.ceil(size / 2000)
    document = F.struct(F.lit("document").alias("type"), ref.alias("ref"), pages.alias("pages"), F.array(said).alias("parts"))
    content = F.when(F.col("role") == "user", listed(image, said)).when(F.col("role") == "assistant", listed(said, audio))
    return turns.withColumn("text", content.otherwise(listed(document)))


def read_back(pieces: DataFrame) -> DataFrame:
    """Digests of every conversation, from its formatted pieces alone.

    Turns and loss are digested without placeholders. Attachments are digested as lines
    kind:position:ref:tokens in the order of their placeholders (an empty ref for null). The
    pieces of a conversation pass one after the other through running digests, so a long one is
    never held whole.
    """
    kind = joined_schema(pieces.select("conv_id"), DIGESTS)
    ordered = in_order(pieces).select("conv_id", "piece", "loss", "attachments")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: object = None
        state: list | None = None
        for batch in batches:
            done: list[tuple] = []
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "piece", "loss", "attachments")]
            for conv, piece, loss, attachments in zip(*columns, strict=True):
                if state is None or conv != key:
                    if state is not None:
                        done.append(_closed(key, state))
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, hashlib.sha256(), 0]
                turns, places = _texts(piece)
                for role, text in turns:
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                for span in loss:
                    trained = unescape(piece[span["start"] : span["end"]])
                    state[2] += len(trained)
                    state[3].update(trained.encode("utf-8", "surrogatepass"))
                state[4] += len(piece)
                known = {f"<|{a['kind']}:{a['position']}|>": a for a in attachments}
                for a in map(known.__getitem__, places):
                    state[5] += 1
                    line = f"{a['kind']}:{a['position']}:{a['ref'] or ''}:{a['tokens']}\n"
                    state[6].update(line.encode("utf-8", "surrogatepass"))
                    state[7] += a["tokens"]
            if done:
                yield _rows(done, batch.schema.field("conv_id").type)
            last = batch.schema.field("conv_id").type
        if state is not None:
            yield _rows([_closed(key, state)], last)

    return ordered.mapInArrow(run, kind)


def _closed(key: object, state: list) -> tuple:
    return (key, *(part if isinstance(part, int) else part.hexdigest() for part in state))


def _rows(done: list[tuple], key: pa.DataType) -> pa.RecordBatch:
    number, text = pa.int64(), pa.string()
    types = (key, number, text, number, text, number, number, text, number)
    names = ["conv_id", *(field.split()[0] for field in DIGESTS.split(","))]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names=names
    )


#: The query's rows in SQL: the conversations and the one more, whose texts hold control strings.
SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, length(text) AS size, coalesce(conv_id::VARCHAR, '') || '/' || coalesce(turn::VARCHAR, '') AS ref,
    CASE role WHEN 'user' THEN 'image' WHEN 'assistant' THEN 'audio' ELSE 'document' END AS kind,
    length(regexp_replace(regexp_replace(role, '(<)(\\*(?:\||/?s>))', '\1\\\2', 'g'), '(\[)(\\*/?INST\])', '\1\\\2', 'g'))
    + length(regexp_replace(regexp_replace(text, '(<)(\\*(?:\||/?s>))', '\1\\\2', 'g'), '(\[)(\\*/?INST\])', '\1\\\2', 'g')) AS escaped
  FROM said
), counted AS (
  SELECT *, CASE kind
    WHEN 'image' THEN greatest(1, ceil((size % 1000) / 28.0)) * greatest(1, ceil((size % 700) / 28.0))
    WHEN 'audio' THEN ceil(size / 16.0 * 25)
    ELSE greatest(1, ceil(size / 2000.0)) * 256 END::BIGINT AS tokens
  FROM sized
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(size) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<|turn|><|said|><|end|>') + escaped + length('<|' || kind || ':0|>'))::BIGINT AS formatted_chars,
  count(*) AS n_attachments,
  sha256(string_agg(kind || ':0:' || ref || ':' || tokens || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS attachments_sha256,
  sum(tokens)::BIGINT AS expanded_tokens
FROM counted GROUP BY conv_id
"""
