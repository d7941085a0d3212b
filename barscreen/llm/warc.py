"""WARC derivatives: from responses to linked metadata and plain-text conversion records.

A derivative points to its response by WARC-Refers-To (with the response's URI, date and payload
digest), keeps the source's URI, date and HTTP headers, and has an identifier computed from the
response's and its own type: building twice gives the same records. The metadata record names
the conversion record and lists title, language, character set and links.

All steps are column expressions on one row a response: no shuffle, whatever the page sizes.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the WARC/1.1 format and of the extraction.
VERSION, EOL = "WARC/1.1", "\r\n"
DATE = "2024-01-01T00:00:00Z"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
TYPES = ("metadata", "conversion")
#: Removed in this order: pattern, replacement. Every pattern takes what it has scanned, an opener
#: that is never closed takes the rest of the page, and tags hold no `<`: so all are linear.
STRIPPED = (
    (r"(?is)<(?:!--(?:.*?-->|.*)|script\b(?:.*?</script\s*>|.*)|style\b(?:.*?</style\s*>|.*))", " "),
    (r"(?is)<head\b(?:.*?(?:</head\s*>|(<body\b))|.*)", " $1"),
    (r"(?i)</?(?:p|div|br|li|ul|ol|h[1-6]|tr|table|article|section|nav|header|footer|main|aside|blockquote|pre|title)\b[^<>]*>", "\n"),
    ("<[^<>]*>", ""),
)
SPACED = (("[ \t\r\f ]+", " "), (" ?\n[ \n]*", "\n"))
TITLE = r"(?is)<title\b[^<>]*>([^<]*)"
#: A value in double quotes, single quotes or none.
_VALUE = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'<>]+))"""
LANG = r"(?is)<html\b[^<>]*?\slang" + _VALUE
CHARSET = r"""(?is)<meta\b[^<>]*?charset\s*=\s*["']?([\w-]+)"""
HREF = r"(?i)<a\s(?:[^<>]*?\s)?href" + _VALUE
ENTITY = "&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
#: Characters of named entities, the frequent ones first as a lookup goes down the list, and of
#: the numbers 128 to 159, which stand for Windows-1252. Names come from the standard library.
_FREQUENT = ("amp", "nbsp", "lt", "gt", "quot", "apos", "copy", "middot", "mdash", "ndash", "hellip", "rsquo", "lsquo", "rdquo", "ldquo")
_NAMED = {n.removesuffix(";"): c for n, c in html5.items() if n.endswith(";") and "\n" not in c}
NAMES = {n: _NAMED[n] for n in _FREQUENT} | _NAMED
NAMES |= {f"#{c}": bytes([c]).decode("cp1252", "ignore") or chr(c) for c in range(128, 160)}
MARK = "\x1f"


def identifier(*parts: Column) -> Column:
    """A urn:uuid from the MD5 of the parts."""
    d = F.md5(F.concat_ws("\n", *parts))
    cut = [F.substring(d, start, n) for start, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text.cast("binary"), 256))


def decoded(text: Column) -> Column:
    """Text with named and numeric entities replaced, each once. Unknown names and entities without
    a semicolon stay; numbers of no character give U+FFFD."""
    known = F.map_from_arrays(*[F.split(F.lit(MARK.join(x)), MARK) for x in (NAMES.keys(), NAMES.values())])

    def one(entity: Column) -> Column:
        name = F.substring(entity, F.lit(2), F.length(entity) - 2)
        hexed = F.conv(F.substring(name, F.lit(3), F.length(name)), 16, 10)
        code = F.when(F.lower(F.substring(name, 1, 2)) == "#x", hexed).otherwise(F.substring(name, F.lit(2), F.length(name))).cast("long")
        real = ((code > 0) & (code < 0xD800)) | ((code > 0xDFFF) & (code <= 0x10FFFF))
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        number = F.coalesce(known[F.concat(F.lit("#"), code.cast("string"))], F.when(real, char).otherwise("\ufffd"))
        return F.when(name.startswith("#"), number).otherwise(F.coalesce(known[name], entity))

    rest = F.split(text, ENTITY, -1)
    found = F.transform(F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)), one)
    both = F.zip_with(rest, found, lambda r, f: F.concat(r, F.coalesce(f, F.lit(""))))
    return F.when(text.contains("&"), F.array_join(both, "")).otherwise(text)


def plain(html: Column) -> Column:
    """Visible text of a page: a line for each block, runs of blanks as one; null gives ''."""
    text = F.coalesce(html, F.lit(""))
    for pattern, to in STRIPPED:
        text = F.regexp_replace(text, pattern, to)
    return text


def spaced(text: Column) -> Column:
    for pattern, to in SPACED:
        text = F.regexp_replace(text, pattern, to)
    return F.btrim(text, F.lit(" \n"))


def value(text: Column, pattern: str) -> Column:
    """What the first match has as its attribute's value, however it is quoted."""
    return F.concat(*[F.regexp_extract(text, pattern, i) for i in (1, 2, 3)])


def responses(pages: DataFrame) -> DataFrame:
    """Response records of (page_id, url, html): identifier, URI, date, HTTP header, payload and
    its digest. Null urls and pages are empty; pages equal throughout share an identifier."""
    html, url = F.coalesce("html", F.lit("")), F.coalesce("url", F.lit(""))
    return pages.select(
        "page_id",
        identifier(F.coalesce(F.col("page_id").cast("string"), F.lit("")), url, F.md5(html)).alias("record_id"),
        url.alias("target_uri"), F.lit(DATE).alias("date"), F.lit(HTTP).alias("http_header"),
        html.alias("payload"), digest(html).alias("payload_digest"),
    )


def derivatives(records: DataFrame) -> DataFrame:
    """Two records of each response, one of each of TYPES, with their blocks and headers.

    Works on the columns that `responses` makes; others are left out. A response with an empty
    payload still has both, the conversion with an empty block.
    """
    one = lambda text: F.trim(F.regexp_replace(text, r"\s+", " "))
    page = F.col("payload")
    tags = F.regexp_extract_all("payload", F.lit(HREF), F.lit(0))
    made = records.withColumns(
        {
            "_stripped": plain(page), "_title": F.regexp_extract("payload", TITLE, 1),
            "_links": F.transform(tags, lambda tag: value(tag, HREF)),
            **{f"_{t}": identifier(F.col("record_id"), F.lit(t)) for t in TYPES},
        }
    )
    # In a step of its own: each text is named several times from here on.
    made = made.withColumns(
        {
            "_text": spaced(decoded(F.col("_stripped"))), "_title": one(decoded(F.col("_title"))),
            "_links": F.filter(F.transform("_links", decoded), lambda x: x != ""),
        }
    )
    fields = (
        ("title", F.col("_title")), ("language", one(value(page, LANG))), ("charset", one(F.regexp_extract("payload", CHARSET, 1))),
        ("source-digest", F.col("payload_digest")), ("conversion", F.col("_conversion")),
        ("text-length", F.length("_text").cast("string")), ("outlink-count", F.size("_links").cast("string")),
    )
    lines = F.concat(*[F.concat(F.lit(f"{name}: "), value, F.lit(EOL)) for name, value in fields])
    outlinks = F.array_join(F.transform("_links", lambda x: F.concat(F.lit("outlink: "), x, F.lit(EOL))), "")
    kinds = F.array(
        F.struct(F.lit("metadata").alias("type"), F.col("_metadata").alias("id"),
                 F.lit("application/warc-fields").alias("content_type"), F.concat(lines, outlinks).alias("block")),
        F.struct(F.lit("conversion").alias("type"), F.col("_conversion").alias("id"),
                 F.lit("text/plain; charset=utf-8").alias("content_type"), F.col("_text").alias("block")),
    )
    rows = made.withColumn("_made", F.explode(kinds))
    return rows.select(
        "page_id", F.col("_made.type").alias("record_type"), F.col("_made.id").alias("record_id"),
        F.col("record_id").alias("refers_to"), "target_uri", "date", "http_header",
        F.col("payload_digest").alias("refers_to_digest"), F.col("_made.content_type").alias("content_type"),
        F.col("_made.block").alias("block"), digest(F.col("_made.block")).alias("block_digest"),
        F.octet_length("_made.block").alias("content_length"),
    )


def serialized(records: DataFrame) -> DataFrame:
    """Adds `record`: the bytes of each derivative as text, header and block, without the two
    line ends that close a record."""
    header = (
        ("WARC-Type", F.col("record_type")), ("WARC-Record-ID", F.col("record_id")),
        ("WARC-Date", F.col("date")), ("WARC-Target-URI", F.col("target_uri")),
        ("WARC-Refers-To", F.col("refers_to")), ("WARC-Refers-To-Target-URI", F.col("target_uri")),
        ("WARC-Refers-To-Date", F.col("date")), ("X-Refers-To-Payload-Digest", F.col("refers_to_digest")),
        ("X-Source-HTTP-Header", F.replace(F.rtrim(F.col("http_header")), F.lit(EOL), F.lit(" | "))),
        ("WARC-Block-Digest", F.col("block_digest")), ("Content-Type", F.col("content_type")),
        ("Content-Length", F.col("content_length").cast("string")),
    )
    lines = F.concat(F.lit(VERSION + EOL), *[F.concat(F.lit(f"{n}: "), v, F.lit(EOL)) for n, v in header])
    return records.withColumn("record", F.concat(lines, F.lit(EOL), F.col("block")))


def write(records: DataFrame, folder: str, compression: str = "gzip") -> None:
    """WARC files of derivatives in a shared folder, one a task: Spark's text writer, which ends
    every record with the two line ends the format wants."""
    out = serialized(records).select("record").write
    out.option("lineSep", EOL * 2).option("compression", compression).text(folder)


def _sql() -> str:
    text = "html"
    for pattern, to in STRIPPED:
        text = f"regexp_replace({text}, '{pattern}', '{to.replace('$', chr(92))}', 'g')"
    blank = "{}"
    for pattern, to in SPACED:
        blank = f"regexp_replace({blank}, '{pattern}', '{to}', 'g')"
    blank = f"trim({blank}, ' ' || chr(10))"
    one = "trim(regexp_replace({}, '\\s+', ' ', 'g'))"
    value = lambda of, p: " || ".join(f"regexp_extract({of}, '{_quoted(p)}', {i})" for i in (1, 2, 3))
    known = "map(string_split({}, chr(31)), string_split({}, chr(31)))".format(
        *[f"'{_quoted(MARK.join(x))}'" for x in (NAMES.keys(), NAMES.values())]
    )
    code = "(CASE WHEN lower(e[2:3]) = '#x' THEN ('0x' || e[4:-2])::BIGINT ELSE e[3:-2]::BIGINT END)"
    char = f"CASE WHEN {code} BETWEEN 1 AND 55295 OR {code} BETWEEN 57344 AND 1114111 THEN chr({code}::INT) ELSE chr(65533) END"
    entity = (
        f"CASE WHEN e[2:2] = '#' THEN coalesce(map_extract(names, '#' || {code})[1], {char})"
        " ELSE coalesce(map_extract(names, e[2:-2])[1], e) END"
    ).replace("e[", "x[2][").replace(", e)", ", x[2])")
    decoded = lambda of: (
        f"array_to_string(list_transform(list_zip(string_split_regex({of}, '{ENTITY}'), regexp_extract_all({of}, '{ENTITY}', 0)),"
        f" lambda x: x[1] || coalesce(CASE WHEN x[2] IS NOT NULL THEN {entity} END, '')), '')"
    )
    uuid = lambda d: (
        f"'<urn:uuid:' || {d}[1:8] || '-' || {d}[9:12] || '-' || {d}[13:16] || '-' || {d}[17:20] || '-' || {d}[21:32] || '>'"
    )
    eol = "chr(13) || chr(10)"
    return f"""
WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
known AS (SELECT {known} AS names),
t AS (SELECT *, {text} AS stripped, regexp_extract(html, '{TITLE}', 1) AS head FROM p, known),
tag AS (SELECT page_id, i, {value("tag", HREF)} AS link FROM (
    SELECT page_id, unnest(tags) AS tag, generate_subscripts(tags, 1) AS i FROM (SELECT page_id, regexp_extract_all(html, '{_quoted(HREF)}', 0) AS tags FROM p))),
links AS (SELECT page_id, list(link ORDER BY i) AS l FROM (SELECT page_id, i, {decoded("link")} AS link FROM tag, known) WHERE link <> '' GROUP BY page_id),
a AS (SELECT t.*, md5(coalesce(t.page_id::VARCHAR, '') || chr(10) || url || chr(10) || md5(html)) AS d,
    {uuid("d")} AS rid, 'sha256:' || sha256(html) AS pd, {blank.format(decoded("stripped"))} AS txt, {one.format(decoded("head"))} AS title,
    coalesce(l, []) AS l FROM t LEFT JOIN links ON links.page_id IS NOT DISTINCT FROM t.page_id),
b AS (SELECT *, md5(rid || chr(10) || 'metadata') AS dm, md5(rid || chr(10) || 'conversion') AS dc,
    {uuid("dm")} AS mid, {uuid("dc")} AS cid FROM a),
c AS (SELECT *, 'title: ' || title || {eol} || 'language: ' || {one.format(value("html", LANG))} || {eol}
    || 'charset: ' || {one.format(f"regexp_extract(html, '{_quoted(CHARSET)}', 1)")}
    || {eol} || 'source-digest: ' || pd || {eol} || 'conversion: ' || cid || {eol} || 'text-length: ' || length(txt)::VARCHAR
    || {eol} || 'outlink-count: ' || len(l)::VARCHAR || {eol}
    || coalesce(array_to_string(['outlink: ' || x || {eol} FOR x IN l], ''), '') AS meta FROM b),
u AS (SELECT page_id, 'metadata' AS record_type, mid AS record_id, rid, url, pd, 'application/warc-fields' AS content_type, meta AS block FROM c
  UNION ALL SELECT page_id, 'conversion', cid, rid, url, pd, 'text/plain; charset=utf-8', txt FROM c)
SELECT page_id, record_type, record_id, rid AS refers_to, url AS target_uri, pd AS refers_to_digest, content_type,
  'sha256:' || sha256(block) AS block_digest, strlen(block)::INT AS content_length FROM u
"""


def _quoted(text: str) -> str:
    return text.replace("'", "''")


SQL = _sql()
