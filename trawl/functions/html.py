"""HTML extraction as Column expressions (title, links, visible text, entities).

Markup is read in linear time, however it is broken. A pattern that begins
somewhere and runs to an end tag rescans the rest of the page from each beginning
that has no end. So the page is first cut behind the last end there is: before
the cut every beginning finds one and is consumed with it, behind it none can.

Everything here is a built-in Spark expression, so it runs inside the JVM
next to the parquet reader; no Python touches the html.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for identical output.
# JavaScript whitespace (`\s`, String.prototype.trim): ASCII \t-\r and space
# plus the Unicode space separators, NBSP and the BOM.
JS_WS = r"[\t-\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
TITLE_MAX_CHARS = 500
TEXT_MAX_CHARS = 100_000
LINK_RE = (r"(?i)<a" + JS_WS + r"[^>]*href" + JS_WS + r"*=" + JS_WS
           + r"*[\x22\x27]([^\x22\x27]*?)[\x22\x27][^>]*>")
# What is dropped from the visible text, in order, with what it begins and ends with.
BLOCKS = (
    (r"(?i)<script[\s\S]*?</script>", "(?i)<script", "</script>"),
    (r"(?i)<style[\s\S]*?</style>", "(?i)<style", "</style>"),
    (r"(?i)<noscript[\s\S]*?</noscript>", "(?i)<noscript", "</noscript>"),
    (r"<!--[\s\S]*?-->", "<!--", "-->"),
    (r"<[^>]+>", "<", ">"),
)
# The first title tag and what stands before the end tag after it. Neither group is
# tried again further on: a later tag ends later, so it cannot do where the first does not.
TITLE_RE = r"(?is)^(?>.*?<title)(?>[^>]*>)(.*?)</title>"
# Named entities decoded, in the order they are applied (case-sensitive).
NAMED_ENTITIES = [
    ("&amp;", "&"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
]
NBSP_ENTITY = ("&nbsp;", " ")
# The same whitespace as a plain character set (for btrim / translate).
JS_WS_CHARS = ("\t\n\x0b\x0c\r \u00a0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
               + "\u2028\u2029\u202f\u205f\u3000\ufeff")
_NON_ASCII_WS = JS_WS_CHARS[6:]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def js_trim(c) -> Column:
    """String.prototype.trim: strip JS whitespace at both ends."""
    return F.btrim(_col(c), F.lit(JS_WS_CHARS))


def collapse_ws(c) -> Column:
    """`replace(/\\s+/g, ' ')` with JS whitespace: map the non-ASCII spaces to
    ' ' (a character map), then collapse ASCII whitespace runs."""
    spaced = F.translate(_col(c), _NON_ASCII_WS, " " * len(_NON_ASCII_WS))
    return F.regexp_replace(spaced, r"[\t-\r ]+", " ")


def _bound(value: Column, use) -> Column:
    """use(value), with `value` computed once for all its uses."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _upto_last(text: Column, end: str) -> Column:
    """The text up to its last `end` and with it; '' if there is none."""
    return F.regexp_extract(text, f"(?is)^(.*{end})", 1)


def _drop_all(text: Column, pattern: str, begin: str, end: str) -> Column:
    """A space for each match of `pattern`, which has that begin and end. The text is
    cut only where something begins behind the last end."""
    def cut(t):
        return _bound(_upto_last(t, end), lambda head: F.concat(
            F.regexp_replace(head, pattern, " "), F.substring(t, F.length(head) + 1, F.length(t))))

    return _bound(text, lambda t: F.when(F.substring_index(t, end, -1).rlike(begin), cut(t)).otherwise(F.regexp_replace(t, pattern, " ")))


def _utf16_char(code: Column) -> Column:
    """String.fromCharCode(n): one UTF-16 unit, n taken modulo 2^16."""
    return F.decode(F.unhex(F.lpad(F.hex(code), 4, "0")), "UTF-16BE")


def _numeric_pass(text: Column, entity_re: str, code_of) -> Column:
    """One left-to-right pass replacing every match of `entity_re`.

    The text is cut into pieces (entity | run without '&' | lone '&'); entity
    pieces are decoded, the rest kept, and the pieces joined again.  Decoded
    characters are never re-scanned, as with a global String.replace.
    """
    pieces = F.regexp_extract_all(text, F.lit(f"(?s)({entity_re}|[^&]+|&)"), 1)
    return F.array_join(F.transform(pieces, lambda x: F.when(
        x.rlike(f"^{entity_re}$"), _utf16_char(code_of(x))).otherwise(x)), "")


def _decimal_code(x: Column) -> Column:
    # parseInt gives a double, whose remainder is exact; one too large for that is 0.
    digits = F.regexp_extract(x, r"^&#([0-9]+);$", 1)
    return F.nanvl(digits.cast("double") % F.lit(65536.0), F.lit(0.0)).cast("int")


def _hex_code(x: Column) -> Column:
    digits = F.regexp_extract(x, r"^&#x([0-9a-fA-F]+);$", 1)
    # n mod 2^16 is the last four hex digits
    return F.conv(F.right(F.lpad(digits, 4, "0"), F.lit(4)), 16, 10).cast("int")


def decode_named(c) -> Column:
    """H4, first part: the six named entities, in order."""
    out = _col(c)
    for ent, ch in NAMED_ENTITIES:
        out = F.replace(out, F.lit(ent), F.lit(ch))
    return out


def decode_rest(c, guarded: bool = False) -> Column:
    """H4, second part: decimal pass, hex pass, then &nbsp;. With `guarded`,
    the numeric passes only run when the text has a '&#' (use it only on a
    materialized column: the guard reads the input twice)."""
    out = _col(c)
    numeric = _numeric_pass(_numeric_pass(out, r"&#[0-9]+;", _decimal_code), r"&#x[0-9a-fA-F]+;", _hex_code)
    if guarded:
        numeric = F.when(F.instr(out, "&#") > 0, numeric).otherwise(out)
    return F.replace(numeric, F.lit(NBSP_ENTITY[0]), F.lit(NBSP_ENTITY[1]))


def decode_entities(c) -> Column:
    """H4: the reference's decode passes, in order, each one global pass:
    six named entities, decimal, hex, then &nbsp; (names are case-sensitive)."""
    return decode_rest(decode_named(c))


def extract_title(html) -> Column:
    """H1: first <title>, entities decoded, trimmed, first 500 chars; '' if absent."""
    inner = F.regexp_extract(F.coalesce(_col(html), F.lit("")), TITLE_RE, 1)
    return F.left(js_trim(decode_entities(inner)), F.lit(TITLE_MAX_CHARS))


def extract_links(html) -> Column:
    """H2: quoted anchor hrefs, trimmed, non-empty, first occurrence kept, in order.

    A tag without a link is consumed up to its end, as an empty match: an anchor that
    begins inside it could only see a part of the same attributes."""
    text = F.coalesce(_col(html), F.lit(""))
    upto = F.when(F.substring_index(text, ">", -1).rlike("(?i)href|<a"), _upto_last(text, ">")).otherwise(text)
    raw = F.regexp_extract_all(upto, F.lit(LINK_RE + "|<a" + JS_WS + "[^>]*"), 1)
    trimmed = F.transform(raw, js_trim)
    return F.array_distinct(F.filter(trimmed, lambda h: h != ""))


def strip_markup(html) -> Column:
    """H3, first part: script/style/noscript blocks, comments, then every tag,
    each replaced by a space; named entities decoded."""
    t = F.coalesce(_col(html), F.lit(""))
    for block in BLOCKS:
        t = _drop_all(t, *block)
    return decode_named(t)


def finish_text(stripped, guarded: bool = False) -> Column:
    """H3, second part: numeric entities, collapse whitespace, trim, cut."""
    return F.left(js_trim(collapse_ws(decode_rest(stripped, guarded))), F.lit(TEXT_MAX_CHARS))


def extract_text(html) -> Column:
    """H3: drop script/style/noscript/comments/tags, decode, collapse spaces, cut."""
    return finish_text(strip_markup(html))


def with_page_fields(df: DataFrame, html: str = "html", *, title: str | None = "title",
                     text: str | None = "body_text", links: str | None = None) -> DataFrame:
    """H1-H3 as two projections: markup stripped (and named entities decoded)
    first, so the numeric-entity passes run only on the pages that have one."""
    pre = {}
    if text:
        pre["_pre_text"] = strip_markup(html)
    if title:
        pre["_pre_title"] = decode_named(F.regexp_extract(F.coalesce(_col(html), F.lit("")), TITLE_RE, 1))
    out = df.withColumns(pre)
    post = {}
    if title:
        post[title] = F.left(js_trim(decode_rest("_pre_title", guarded=True)), F.lit(TITLE_MAX_CHARS))
    if text:
        post[text] = finish_text("_pre_text", guarded=True)
    if links:
        post[links] = extract_links(html)
    return out.withColumns(post).drop(*pre)
