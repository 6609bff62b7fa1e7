"""WARC derivatives: metadata and plain-text conversion records of response records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txmon.llm.common import let

_LINE = "\r\n"
_GAP = "\r\n\r\n"
# Elements whose content is no text, to their end tag or the end of the page.
_HIDDEN = "(?is)<!--.*?(?:-->|\\z)" + "".join(
    f"|<{name}\\b.*?(?:</{name}[^>]*>|\\z)"
    for name in ("script", "style", "noscript", "template", "svg")
)
_BLOCK_TAG = (
    "(?i)</?(?:p|br|div|li|ul|ol|dl|dt|dd|h[1-6]|hr|tr|td|th|table|article|section|header|footer"
    "|nav|aside|main|title|head|body|html|blockquote|pre|form|option|figure|figcaption)\\b[^>]*>"
)
_OTHER_TAG = "<[A-Za-z/!?][^>]*>"
_ENTITY = "^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
# Named character references that are resolved.
_NAMED = {
    "amp": "&",
    "lt": "<",
    "gt": ">",
    "quot": '"',
    "apos": "'",
    "nbsp": " ",
    "copy": "©",
    "reg": "®",
    "trade": "™",
    "middot": "·",
    "bull": "•",
    "hellip": "…",
    "ndash": "–",
    "mdash": "—",
    "lsquo": "‘",
    "rsquo": "’",
    "ldquo": "“",
    "rdquo": "”",
    "laquo": "«",
    "raquo": "»",
    "euro": "€",
    "pound": "£",
    "deg": "°",
    "sect": "§",
    "times": "×",
}
_LATIN = ("iso-8859-1", "latin1", "latin-1", "us-ascii")


def _unescape(text: Column) -> Column:
    """Resolves character references, each once; unknown ones stay as written."""
    named = F.create_map(*(F.lit(x) for pair in _NAMED.items() for x in pair))

    def character(number: Column) -> Column:
        """One by its number; none for what is no character."""
        valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        return F.when(
            valid, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        ).otherwise("�")

    def resolve(part: Column) -> Column:
        def known(name: Column) -> Column:
            number = F.when(
                name.rlike("^#[xX]"), F.conv(F.substring(name, 3, 10), 16, 10).cast("long")
            ).when(name.startswith("#"), F.substring(name, 2, 10).cast("long"))
            found = F.coalesce(F.get(F.array(F.try_element_at(named, name)), F.lit(0)),
                               F.when(number.isNotNull(), character(number)))
            rest = F.substring(part, F.length(name) + 2, F.length(part))
            return F.coalesce(F.concat(found, rest), F.concat(F.lit("&"), part))

        return F.when(part.rlike(_ENTITY), let(F.regexp_extract(part, _ENTITY, 1), known)).otherwise(
            F.concat(F.lit("&"), part)
        )

    return F.array_join(
        F.transform(F.split(text, "&"), lambda p, i: F.when(i == 0, p).otherwise(resolve(p))), ""
    )


def html_text(html: Column) -> Column:
    """The visible text of a page: a line per block, white space collapsed."""
    shown = F.regexp_replace(html, _HIDDEN, "")
    lines = F.regexp_replace(shown, "[\r\n]+", " ")
    lines = F.regexp_replace(lines, _BLOCK_TAG, "\n")
    plain = _unescape(F.regexp_replace(lines, _OTHER_TAG, ""))
    single = F.regexp_replace(plain, "[ \\t\\x0b\\f\\r\\xa0]+", " ")
    return F.trim(F.regexp_replace(single, " ?\\n[ \\n]*", "\n"), F.lit(" \n"))


def _digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block, 256))


def _record_id(kind: str, source: Column) -> Column:
    """Names a derivative after its source, so that a repeated run gives the same ids."""
    return let(
        F.md5(F.concat(F.lit(kind + " "), F.coalesce(source, F.lit(""))).cast("binary")),
        lambda h: F.concat(
            F.lit("<urn:uuid:"),
            F.concat_ws(
                "-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
            ),
            F.lit(">"),
        ),
    )


def _field(name: str, value: Column) -> Column:
    """One header line, or NULL where there is no value."""
    return F.concat(F.lit(f"{name}: "), F.regexp_replace(value, "[\r\n]+", " "))


def responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Pages ``(page_id, url, html)`` as response records ``(record_id, target_uri, date, block)``."""
    html = F.coalesce("html", F.lit(""))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(html).cast("string"),
        F.lit(_GAP),
    )
    return pages.select(
        _record_id("response", F.col("page_id").cast("string")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(date).alias("date"),
        F.concat(head, html).cast("binary").alias("block"),
    )


def derivatives(source: DataFrame) -> DataFrame:
    """A metadata and a conversion record for every response record.

    ``source`` has ``record_id, target_uri, date, block``, the block being a whole HTTP response
    in bytes. The result has ``record_type, record_id, refers_to, target_uri, date,
    content_type, block, content_length, block_digest, source_block_digest,
    source_payload_digest, header``. The metadata block lists status, source headers, digests,
    title, links and the id of the conversion, a name and value a line. Both records refer to
    the response by its id, URI and date.

    A NULL block is empty. A block without an empty line is all payload, with no status or
    headers. A charset other than Latin-1 is read as UTF-8, invalid bytes replaced. A NULL URI,
    date or id leaves its header line out; repeated rows give repeated records with equal ids.
    Other columns are ignored. No rows give no records.
    """
    block = F.coalesce(F.col("block").cast("binary"), F.lit(b""))
    raw = source.select("record_id", "target_uri", "date", block.alias("block")).select(
        "*",
        F.when(
            F.col("block").cast("string").contains(_GAP),
            F.substring_index(F.col("block").cast("string"), _GAP, 1),
        ).alias("head"),
    )
    body = F.when(
        F.col("head").isNotNull(),
        F.expr("substring(block, octet_length(head) + 5)"),
    ).otherwise(F.col("block"))
    split = raw.select(
        "record_id",
        "target_uri",
        "date",
        F.make_valid_utf8("head").alias("head"),
        body.alias("payload"),
        _digest(F.col("block")).alias("source_block_digest"),
    )
    mime = F.nullif(
        F.trim(F.regexp_extract("head", "(?im)^content-type:([^\\r\\n]*)", 1)), F.lit("")
    )
    charset = F.lower(F.regexp_extract(mime, "(?i)charset=[\"']?([^\"'; ]+)", 1))
    html = F.when(charset.isin(*_LATIN), F.decode("payload", "ISO-8859-1")).otherwise(
        F.make_valid_utf8(F.col("payload").cast("string"))
    )
    read = split.select(
        "record_id",
        "target_uri",
        "date",
        "head",
        "source_block_digest",
        _digest(F.col("payload")).alias("source_payload_digest"),
        let(
            html,
            lambda page: F.struct(
                html_text(page).alias("text"),
                html_text(F.nullif(F.regexp_extract(page, "(?is)<title[^>]*>(.*?)</title", 1), F.lit("")))
                .alias("title"),
                F.regexp_extract_all(
                    page, F.lit("(?i)<a\\s[^>]*?href=[\"']([^\"'<>]*)[\"']"), F.lit(1)
                ).alias("links"),
            ),
        ).alias("page"),
        mime.alias("mime"),
    )
    conversion_id = _record_id("conversion", F.col("record_id"))
    head_lines = F.split("head", _LINE)
    fields = F.concat_ws(
        _LINE,
        _field("http-status", F.nullif(F.regexp_extract("head", "^HTTP/\\S+ ([0-9]{3})", 1), F.lit(""))),
        F.transform(
            F.slice(head_lines, 2, F.size(head_lines)),
            lambda x: F.concat(F.lit("http-header: "), x),
        ),
        _field("source-block-digest", F.col("source_block_digest")),
        _field("source-payload-digest", F.col("source_payload_digest")),
        _field("conversion", conversion_id),
        _field("title", F.col("page.title")),
        F.transform("page.links", lambda x: F.concat(F.lit("outlink: "), _unescape(x))),
    )
    made = read.select(
        "*",
        F.inline(
            F.array(
                _made("metadata", "application/warc-fields", fields),
                _made("conversion", "text/plain; charset=UTF-8", F.col("page.text")),
            )
        ),
    ).select(
        "record_type",
        "derived_id",
        F.col("record_id").alias("refers_to"),
        "target_uri",
        "date",
        "content_type",
        F.col("derived").alias("block"),
        F.octet_length("derived").cast("long").alias("content_length"),
        _digest(F.col("derived").cast("binary")).alias("block_digest"),
        "source_block_digest",
        "source_payload_digest",
    )
    header = F.concat_ws(
        _LINE,
        F.lit("WARC/1.1"),
        _field("WARC-Type", F.col("record_type")),
        _field("WARC-Record-ID", F.col("derived_id")),
        _field("WARC-Date", F.col("date")),
        _field("WARC-Target-URI", F.col("target_uri")),
        _field("WARC-Refers-To", F.col("refers_to")),
        _field("WARC-Refers-To-Target-URI", F.col("target_uri")),
        _field("WARC-Refers-To-Date", F.col("date")),
        _field("WARC-Block-Digest", F.col("block_digest")),
        _field("WARC-Source-Payload-Digest", F.col("source_payload_digest")),
        _field("Content-Type", F.col("content_type")),
        _field("Content-Length", F.col("content_length").cast("string")),
    )
    return made.select("*", header.alias("header")).withColumnRenamed("derived_id", "record_id")


def _made(kind: str, content_type: str, block: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("record_type"),
        _record_id(kind, F.col("record_id")).alias("derived_id"),
        F.lit(content_type).alias("content_type"),
        block.alias("derived"),
    )


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """WARC files below ``path``, one a task: header, empty line, block, two line ends."""
    whole = F.concat("header", F.lit(_GAP), "block")
    records.select(whole).write.text(path, compression=compression, lineSep=_GAP)


def op1_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derivatives(responses(spark.read.parquet(f"{sf_dir}/pages.parquet"))).select(
        "record_type",
        "record_id",
        "refers_to",
        "target_uri",
        "content_length",
        "block_digest",
        "source_block_digest",
        "source_payload_digest",
        F.sha2("header", 256).alias("header_sha256"),
    )



def _sql_id(kind: str, source: str) -> str:
    parts = "^(.{8})(.{4})(.{4})(.{4})(.*)$"
    named = f"md5('{kind} ' || {source})"
    return rf"'<urn:uuid:' || regexp_replace({named}, '{parts}', '\1-\2-\3-\4-\5') || '>'"


def _sql_unescape(text: str) -> str:
    named = " ".join(f"WHEN '{name}' THEN chr({ord(value)})" for name, value in _NAMED.items())
    name = rf"regexp_extract(x, '{_ENTITY}', 1)"
    return f"""array_to_string(list_transform(string_split({text}, '&'), lambda x, i: CASE
      WHEN i = 1 THEN x WHEN {name} = '' THEN '&' || x
      WHEN {name}[1] = '#' THEN chr(CAST(CASE WHEN lower({name}[2]) = 'x'
        THEN '0x' || substr({name}, 3) ELSE substr({name}, 2) END AS INTEGER))
        || substr(x, length({name}) + 2)
      ELSE coalesce(CASE {name} {named} END || substr(x, length({name}) + 2), '&' || x) END), '')"""


def _sql_text(html: str) -> str:
    shown = f"regexp_replace({html}, '{_HIDDEN}', '', 'g')"
    lines = rf"regexp_replace({shown}, '[\r\n]+', ' ', 'g')"
    lines = f"regexp_replace({lines}, '{_BLOCK_TAG}', chr(10), 'g')"
    plain = _sql_unescape(f"regexp_replace({lines}, '{_OTHER_TAG}', '', 'g')")
    single = rf"regexp_replace({plain}, '[ \t\x0b\f\r\xa0]+', ' ', 'g')"
    return rf"trim(regexp_replace({single}, ' ?\n[ \n]*', chr(10), 'g'), ' ' || chr(10))"


OP1_SQL = rf"""
WITH p AS (
  SELECT {_sql_id("response", "CAST(page_id AS VARCHAR)")} AS refers_to, url AS target_uri,
         chr(13) || chr(10) AS nl, coalesce(html, '') AS html FROM pages),
q AS (
  SELECT *, 'Content-Length: ' || octet_length(CAST(encode(html) AS BLOB)) AS size,
         'sha256:' || sha256(html) AS source_payload_digest,
         {_sql_id("metadata", "refers_to")} AS metadata_id,
         {_sql_id("conversion", "refers_to")} AS conversion_id,
         {_sql_text("html")} AS text,
         {_sql_text("nullif(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title', 1), '')")}
           AS title,
         regexp_extract_all(html, '(?i)<a\s[^>]*?href=["'']([^"''<>]*)["'']', 1) AS links
  FROM p),
s AS (
  SELECT *, 'sha256:' || sha256(concat_ws(nl, 'HTTP/1.1 200 OK',
           'Content-Type: text/html; charset=utf-8', size, '', html)) AS source_block_digest
  FROM q),
b AS (
  SELECT 'conversion' AS record_type, conversion_id AS record_id, text AS block,
         'text/plain; charset=UTF-8' AS content_type, * EXCLUDE (text) FROM s
  UNION ALL
  SELECT 'metadata', metadata_id,
         concat_ws(nl, 'http-status: 200', 'http-header: Content-Type: text/html; charset=utf-8',
           'http-header: ' || size, 'source-block-digest: ' || source_block_digest,
           'source-payload-digest: ' || source_payload_digest, 'conversion: ' || conversion_id,
           'title: ' || regexp_replace(title, '[\r\n]+', ' ', 'g'),
           nullif(array_to_string(list_transform(links,
             lambda l: 'outlink: ' || {_sql_unescape("l")}), chr(13) || chr(10)), '')),
         'application/warc-fields', * EXCLUDE (text) FROM s),
d AS (
  SELECT *, CAST(octet_length(CAST(encode(block) AS BLOB)) AS BIGINT) AS content_length,
         'sha256:' || sha256(block) AS block_digest FROM b)
SELECT record_type, record_id, refers_to, target_uri, content_length, block_digest,
       source_block_digest, source_payload_digest,
       sha256(concat_ws(nl, 'WARC/1.1', 'WARC-Type: ' || record_type,
         'WARC-Record-ID: ' || record_id, 'WARC-Date: 2024-01-01T00:00:00Z',
         'WARC-Target-URI: ' || target_uri, 'WARC-Refers-To: ' || refers_to,
         'WARC-Refers-To-Target-URI: ' || target_uri,
         'WARC-Refers-To-Date: 2024-01-01T00:00:00Z', 'WARC-Block-Digest: ' || block_digest,
         'WARC-Source-Payload-Digest: ' || source_payload_digest,
         'Content-Type: ' || content_type, 'Content-Length: ' || content_length))
         AS header_sha256
FROM d
"""
