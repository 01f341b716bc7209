"""URL parsing, resolution and canonical form.

The WHATWG URL steps the reference relies on are re-stated with regexes and
higher-order array functions, so the computation stays a JVM expression:
split into scheme/authority/path/query, resolve a relative reference against a
base, remove dot segments, percent-encode the path, drop the default port and
the fragment, and re-serialize the query sorted by name.

Intermediate values are bound to lambda variables (see `_Let`), so each is
computed once per row and the expression stays small wherever Catalyst moves
it (a filter on a normalized URL is pushed down into the scan).
"""
from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.functions.html import JS_WS
from trawl.functions.hosts import parse_host
from trawl.functions.text import tokenize

# Fixed values that must equal the reference's.
REJECTED_PREFIX_RE = r"(?i)^(mailto:|javascript:|tel:|data:|ftp:)"
ALLOWED_SCHEMES = ("http", "https")
SKIP_EXTENSIONS = (
    ".png", ".jpg", ".jpeg", ".gif", ".svg", ".webp", ".ico",
    ".pdf", ".zip", ".tar", ".gz", ".rar", ".7z",
    ".mp3", ".mp4", ".avi", ".mov", ".wmv", ".flv",
    ".css", ".js", ".json", ".xml", ".rss", ".atom",
    ".woff", ".woff2", ".ttf", ".eot",
    ".exe", ".dmg", ".msi", ".apk",
)
# WHATWG facts: special schemes and their default ports.
SPECIAL_SCHEMES = ("http", "https", "ws", "wss", "ftp", "file")
DEFAULT_PORTS = {"http": 80, "https": 443, "ws": 80, "wss": 443, "ftp": 21}
# Code points percent-encoded in a path: C0 controls, space, DEL, non-ASCII
# and  " < > ` { }  (# and ? end the path before this step).
PATH_ENCODE_RE = r"[^\x21-\x7E]|[\x22<>\x60{}]"

_SCHEME_RE = r"(?s)^([A-Za-z][A-Za-z0-9+.\-]*):(.*)$"
_HAS_SCHEME_RE = r"^[A-Za-z][A-Za-z0-9+.\-]*:"
_DOT_SEGMENT_RE = r"(?i)(^|/)(\.|%2e){1,2}(/|$)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


class _Let:
    """Step-wise construction of one compact expression.

    Each step binds the values computed so far as a struct to a lambda
    variable (`transform(array(struct), s -> ...)[1]`), so a value used many
    times is evaluated once, and the expression stays linear in size even when
    Catalyst inlines it into a pushed-down filter.
    """

    def __init__(self, **cols: Column):
        self.names = list(cols)
        self.col = F.struct(*[c.alias(k) for k, c in cols.items()])

    def add(self, fn) -> "_Let":
        names, added = list(self.names), []

        def body(s):
            new = fn(lambda n: s[n])
            added.extend(new)
            return F.struct(*[s[n].alias(n) for n in names if n not in new],
                            *[v.alias(k) for k, v in new.items()])

        self.col = F.element_at(F.transform(F.array(self.col), body), 1)
        self.names = [n for n in names if n not in added] + added
        return self

    def keep(self, *names: str) -> "_Let":
        return self.add(lambda g: {}) if not names else self._project(names)

    def _project(self, names) -> "_Let":
        def body(s):
            return F.struct(*[s[n].alias(n) for n in names])

        self.col = F.element_at(F.transform(F.array(self.col), body), 1)
        self.names = list(names)
        return self


def _clean(raw: Column) -> Column:
    """Leading/trailing C0+space and JS whitespace removed; tab/LF/CR dropped."""
    # One class and no group, so that long runs of spaces neither recurse nor backtrack.
    ends = rf"[{JS_WS}\x00-\x20]"
    s = F.regexp_replace(raw, rf"^{ends}+|(?<!{ends}){ends}+$", "")
    return F.regexp_replace(s, r"[\t\n\r]", "")


def _parse(L: _Let, src: str, p: str) -> _Let:
    """Absolute parse of field `src` into `{p}scheme/auth/path/query/hq`."""
    L.add(lambda g: {
        f"{p}scheme": F.lower(F.regexp_extract(g(src), _SCHEME_RE, 1)),
        f"{p}rest": F.regexp_extract(g(src), _SCHEME_RE, 2)})
    L.add(lambda g: {
        f"{p}arest": F.when(g(f"{p}scheme").isin(*SPECIAL_SCHEMES),
                            F.regexp_replace(g(f"{p}rest"), r"^[/\\]*", ""))
        .when(g(f"{p}rest").startswith("//"), F.substring(g(f"{p}rest"), 3, 1 << 30))})
    L.add(lambda g: {
        f"{p}auth": F.regexp_extract(g(f"{p}arest"), r"(?s)^([^/\\?#]*)", 1),
        f"{p}after": F.when(g(f"{p}arest").isNull(), g(f"{p}rest"))
        .otherwise(F.regexp_extract(g(f"{p}arest"), r"(?s)^[^/\\?#]*(.*)$", 1))})
    return L.add(lambda g: {
        f"{p}path": F.regexp_extract(g(f"{p}after"), r"(?s)^([^?#]*)", 1),
        f"{p}query": F.regexp_extract(g(f"{p}after"), r"(?s)^[^?#]*\?([^#]*)", 1),
        f"{p}hq": g(f"{p}after").rlike(r"^[^?#]*\?")})


def _relative(L: _Let, src: str, p: str) -> _Let:
    """Split a relative reference: network-path and path-or-query forms."""
    L.add(lambda g: {f"{p}net": F.regexp_replace(g(src), r"^[/\\]{2}", "")})
    L.add(lambda g: {
        f"{p}nauth": F.regexp_extract(g(f"{p}net"), r"(?s)^([^/\\?#]*)", 1),
        f"{p}nafter": F.regexp_extract(g(f"{p}net"), r"(?s)^[^/\\?#]*(.*)$", 1)})
    return L.add(lambda g: {
        f"{p}npath": F.regexp_extract(g(f"{p}nafter"), r"(?s)^([^?#]*)", 1),
        f"{p}nquery": F.regexp_extract(g(f"{p}nafter"), r"(?s)^[^?#]*\?([^#]*)", 1),
        f"{p}nhq": g(f"{p}nafter").rlike(r"^[^?#]*\?"),
        f"{p}rpath": F.regexp_extract(g(src), r"(?s)^([^?#]*)", 1),
        f"{p}rquery": F.regexp_extract(g(src), r"(?s)^[^?#]*\?([^#]*)", 1),
        f"{p}rhq": g(src).rlike(r"^[^?#]*\?")})


def remove_dot_segments(path: Column) -> Column:
    """RFC 3986 / WHATWG dot-segment removal for a path starting with '/'.
    `path` must be a plain column reference (it is used more than once)."""
    segs = F.slice(F.split(path, "/"), 2, 1 << 30)
    tagged = F.transform(segs, lambda seg, i: F.struct(
        F.lower(seg).alias("s"), seg.alias("raw"), (i == F.size(segs) - 1).alias("last")))

    def step(acc, x):
        is_dot = x["s"].isin(".", "%2e")
        is_up = x["s"].isin("..", ".%2e", "%2e.", "%2e%2e")
        popped = F.when(F.size(acc) > 0, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc)
        tail = F.array(F.lit(""))
        return (
            F.when(is_up, F.when(x["last"], F.concat(popped, tail)).otherwise(popped))
            .when(is_dot, F.when(x["last"], F.concat(acc, tail)).otherwise(acc))
            .otherwise(F.concat(acc, F.array(x["raw"]))))

    resolved = F.aggregate(tagged, F.array().cast("array<string>"), step)
    out = F.concat(F.lit("/"), F.array_join(resolved, "/"))
    return F.when(path.startswith("/") & path.rlike(_DOT_SEGMENT_RE), out).otherwise(path)


def percent_encode_path(path: Column) -> Column:
    """Percent-encode (UTF-8, upper-case hex) the code points of the path set.
    `path` must be a plain column reference."""
    chars = F.regexp_extract_all(path, F.lit("(?s)(.)"), 1)
    enc = F.array_join(F.transform(chars, lambda ch: F.when(
        ch.rlike(PATH_ENCODE_RE),
        F.regexp_replace(F.hex(F.encode(ch, "UTF-8")), "(..)", "%$1")).otherwise(ch)), "")
    return F.when(path.rlike(PATH_ENCODE_RE), enc).otherwise(path)


def _form_decode(x: Column) -> Column:
    """application/x-www-form-urlencoded parse of one name or value; a percent sign
    that begins no escape stands for itself."""
    escaped = F.regexp_replace(x, "%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(escaped), F.replace(x, F.lit("+"), F.lit(" ")))


def sorted_query(query: Column) -> Column:
    """URLSearchParams.sort() then serialization; '' when no pair remains.
    Stable: ties on the name keep their original position."""
    parts = F.filter(F.split(query, "&"), lambda q: q != "")
    pairs = F.transform(parts, lambda q, i: F.struct(
        _form_decode(F.regexp_extract(q, r"(?s)^([^=]*)", 1)).alias("name"),
        i.alias("pos"),
        _form_decode(F.regexp_extract(q, r"(?s)^[^=]*=?(.*)$", 1)).alias("value")))
    ser = F.transform(F.array_sort(pairs), lambda kv: F.concat(
        F.url_encode(kv["name"]), F.lit("="), F.url_encode(kv["value"])))
    return F.array_join(ser, "&")


_PART_NAMES = ("s", "scheme", "userinfo", "host", "port", "path", "query", "hq", "valid")


def url_parts(raw, base=None) -> Column:
    """Struct(s, scheme, userinfo, host, port, path, query, hq, valid): the URL
    as the WHATWG parser sees it (resolved against `base` when given; path
    percent-encoded and dot segments removed; host lower-cased; default port
    null)."""
    cols = {"s": _clean(_col(raw))}
    if base is not None:
        cols["b"] = _clean(_col(base))
    L = _Let(**cols)
    _parse(L, "s", "a_")
    if base is None:
        L.add(lambda g: {
            "scheme": g("a_scheme"), "auth": F.when(g("a_scheme") != "", g("a_auth")),
            "path0": g("a_path"), "query": g("a_query"), "hq": g("a_hq"), "ok": g("a_scheme") != ""})
    else:
        _parse(L, "b", "b_")
        _relative(L, "s", "r_")
        L.add(lambda g: {
            "kind": F.when(g("s").rlike(_HAS_SCHEME_RE), "abs")
            .when((g("b_scheme") == "") | ~g("b_scheme").isin(*SPECIAL_SCHEMES), "bad")
            .when(g("s").rlike(r"^[/\\]{2}"), "net").when(g("s").rlike(r"^[/\\]"), "root")
            .when(g("s").startswith("?"), "query").when(g("s").startswith("#") | (g("s") == ""), "frag")
            .otherwise("rel"),
            "bdir": F.regexp_extract(g("b_path"), r"(?s)^(.*/)", 1)})

        def resolve(g):
            k = g("kind")
            return {
                "scheme": F.when(k == "abs", g("a_scheme")).when(k == "bad", "").otherwise(g("b_scheme")),
                "auth": F.when(k == "abs", F.when(g("a_scheme") != "", g("a_auth")))
                .when(k == "net", g("r_nauth")).when(k == "bad", F.lit(None)).otherwise(g("b_auth")),
                "path0": F.when(k == "abs", g("a_path")).when(k == "net", g("r_npath"))
                .when(k == "root", g("r_rpath")).when(k.isin("query", "frag"), g("b_path"))
                .when(k == "rel", F.concat(F.when(g("bdir") == "", "/").otherwise(g("bdir")), g("r_rpath")))
                .otherwise(""),
                "query": F.when(k == "abs", g("a_query")).when(k == "net", g("r_nquery"))
                .when(k == "frag", g("b_query")).otherwise(g("r_rquery")),
                "hq": F.when(k == "abs", g("a_hq")).when(k == "net", g("r_nhq"))
                .when(k == "frag", g("b_hq")).otherwise(g("r_rhq")),
                "ok": F.when(k == "abs", g("a_scheme") != "").otherwise(k != "bad")}

        L.add(resolve)
    L.keep("s", "scheme", "auth", "path0", "query", "hq", "ok")

    def authority(g):
        special = g("scheme").isin(*SPECIAL_SCHEMES)
        return {
            "userinfo": F.regexp_extract(g("auth"), r"(?s)^(.*)@", 1),
            "hostport": F.regexp_extract(g("auth"), r"(?s)^(?:.*@)?(.*)$", 1),
            "path1": F.when(special, F.replace(g("path0"), F.lit("\\"), F.lit("/"))).otherwise(g("path0"))}

    L.add(authority)
    L.add(lambda g: {
        "host0": F.regexp_extract(g("hostport"), r"(?s)^(\[[^\]]*\](?=:|$)|[^:]*)", 1),
        "porttxt": F.regexp_extract(g("hostport"), r"(?s)^(?:\[[^\]]*\]|[^:\[][^:]*|):(.*)$", 1),
        "path2": F.when(g("scheme").isin(*SPECIAL_SCHEMES) & (g("path1") == ""), F.lit("/"))
        .otherwise(g("path1"))})

    # A host that is not valid is null.
    L.add(lambda g: {"host": F.when(g("scheme").isin(*SPECIAL_SCHEMES), parse_host(g("host0"))).otherwise(F.lower(g("host0")))})

    def finish(g):
        special = g("scheme").isin(*SPECIAL_SCHEMES)
        default_port = F.lit(None).cast("int")
        for sch, prt in DEFAULT_PORTS.items():
            default_port = F.when(g("scheme") == sch, F.lit(prt)).otherwise(default_port)
        pt = g("porttxt")
        port_num = F.when(pt != "", pt.try_cast("int"))
        return {
            "port": F.when(port_num != default_port, port_num.cast("string"))
            .when(default_port.isNull() & port_num.isNotNull(), port_num.cast("string")),
            "valid": F.coalesce(g("ok") & F.when(
                special & (g("scheme") != "file"),
                g("auth").isNotNull() & g("host").isNotNull()
                & ((pt == "") | (pt.rlike(r"^[0-9]{1,5}$") & (pt.try_cast("int") <= 65535)))
            ).otherwise(True), F.lit(False)),
            "path3": remove_dot_segments(g("path2"))}

    L.add(finish)
    L.add(lambda g: {"path": percent_encode_path(g("path3"))})
    L.keep(*_PART_NAMES)
    return L.col


def _normalized(parts: Column) -> Column:
    def body(g):
        path = g["path"]
        path = F.when((F.length(path) > 1) & path.endswith("/"),
                      F.regexp_replace(path, "/$", "")).otherwise(path)
        q = F.when(g["hq"], sorted_query(g["query"])).otherwise(F.lit(""))
        out = F.concat(
            g["scheme"], F.lit("://"),
            F.when(g["userinfo"] != "", F.concat(g["userinfo"], F.lit("@"))).otherwise(F.lit("")),
            g["host"],
            F.when(g["port"].isNotNull(), F.concat(F.lit(":"), g["port"])).otherwise(F.lit("")),
            path,
            F.when(q != "", F.concat(F.lit("?"), q)).otherwise(F.lit("")))
        s = g["s"]
        ok = ((s != "") & ~s.rlike(REJECTED_PREFIX_RE) & g["valid"] & g["scheme"].isin(*ALLOWED_SCHEMES))
        return F.when(F.coalesce(ok, F.lit(False)), out)

    return F.element_at(F.transform(F.array(parts), body), 1)


# Fast path: inputs whose canonical form is a plain rewrite of the text. A
# path of characters that need no encoding, no dot segment, no backslash; a
# lower-case host without port or user; no query or a single simple pair.
_CANON_PATH_CHARS = r"[A-Za-z0-9\-._~!$&'()*+,;=:@%/]"
# any path character but controls, whitespace (JavaScript's set), `\`, `?`, `#`
_PATH_CHARS = (r"[^\x00-\x20\x7F\\?#\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}"
               r"\x{202F}\x{205F}\x{3000}\x{FEFF}]")
_SIMPLE_QUERY = r"(\?[A-Za-z0-9*\-._]+=[A-Za-z0-9*\-._]*)?"
# A host whose last label begins with a digit may be an IPv4 address, which has more than one form.
_NAMED = r"(?:[a-z0-9-]+\.)*[a-z][a-z0-9-]*"
SIMPLE_ABS_RE = rf"^(?i:https?)://{_NAMED}(/{_PATH_CHARS}*)?{_SIMPLE_QUERY}(#.*)?$"
SIMPLE_ROOT_RE = rf"^/(?!/){_PATH_CHARS}*{_SIMPLE_QUERY}(#.*)?$"
CANON_BASE_RE = rf"^https?://{_NAMED}(/|$)"


def _simple_path(path: Column) -> Column:
    """Percent-encoded; empty path -> '/', one trailing slash dropped (unless root)."""
    p = percent_encode_path(path)
    return (F.when(p == "", F.lit("/"))
            .when((F.length(p) > 1) & p.endswith("/"), F.regexp_replace(p, "/$", ""))
            .otherwise(p))


def _fast_abs(raw: Column) -> Column:
    scheme = F.lower(F.regexp_extract(raw, r"^([A-Za-z]+)://", 1))
    host = F.regexp_extract(raw, r"^[A-Za-z]+://([a-z0-9.-]+)", 1)
    path = F.regexp_extract(raw, r"^[A-Za-z]+://[a-z0-9.-]+([^?#]*)", 1)
    query = F.regexp_extract(raw, r"^[^?#]*(\?[^#]*)", 1)
    return F.concat(scheme, F.lit("://"), host, _simple_path(path), query)


def _fast_root(raw: Column, base: Column) -> Column:
    origin = F.regexp_extract(base, r"^(https?://[a-z0-9.-]+)", 1)
    path = F.regexp_extract(raw, r"^([^?#]*)", 1)
    query = F.regexp_extract(raw, r"^[^?#]*(\?[^#]*)", 1)
    return F.concat(origin, _simple_path(path), query)


def normalize_url(raw, base=None) -> Column:
    """Canonical http(s) URL string of `raw` (resolved against `base`),
    or null when rejected or unparsable.

    Simple inputs take a code-generated rewrite; every other input goes
    through the full parse (`url_parts`)."""
    r = _col(raw)
    full = _normalized(url_parts(raw, base))
    simple = r.rlike(SIMPLE_ABS_RE) & ~r.rlike(_DOT_SEGMENT_RE)
    out = F.when(simple, _fast_abs(r))
    if base is not None:
        b = _col(base)
        root = r.rlike(SIMPLE_ROOT_RE) & ~r.rlike(_DOT_SEGMENT_RE) & b.rlike(CANON_BASE_RE)
        out = out.when(root, _fast_root(r, b))
    return out.otherwise(full)


def _with_parts(parts: Column, fn) -> Column:
    return F.element_at(F.transform(F.array(parts), fn), 1)


CANON_SIMPLE_RE = rf"^https?://{_NAMED}(/{_CANON_PATH_CHARS}*)?(\?[^#\s]*)?$"


def _facts(url, fn) -> Column:
    """Evaluate `fn(parts)` on the URL's parts: canonical simple URLs are
    split by three regexes, everything else through the full parse."""
    u = _col(url)
    fast = F.struct(
        F.lit(True).alias("valid"),
        F.regexp_extract(u, r"^https?://([a-z0-9.-]+)", 1).alias("host"),
        F.regexp_extract(u, r"^https?://[a-z0-9.-]+([^?#]*)", 1).alias("path0"),
        F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1).alias("query"))
    fast_parts = F.struct(fast["valid"].alias("valid"), fast["host"].alias("host"),
                          F.when(fast["path0"] == "", F.lit("/")).otherwise(fast["path0"]).alias("path"),
                          fast["query"].alias("query"))
    simple = u.rlike(CANON_SIMPLE_RE) & ~u.rlike(_DOT_SEGMENT_RE)
    return F.when(simple, fn(fast_parts)).otherwise(_with_parts(url_parts(url), fn))


def skip_by_extension(url) -> Column:
    """True when the lower-cased path ends in a skipped extension; unparsable -> true."""
    return _facts(url, lambda g: F.when(
        g["valid"], F.regexp_extract(F.lower(g["path"]), r"(\.[^.]*)$", 1).isin(*SKIP_EXTENSIONS))
        .otherwise(F.lit(True)))


def extension(url) -> Column:
    """Lower-cased extension of the path ('' when none), null if unparsable."""
    return _facts(url, lambda g: F.when(
        g["valid"], F.regexp_extract(F.lower(g["path"]), r"(\.[^.]*)$", 1)))


def hostname(url) -> Column:
    """U4: lower-case host of an absolute URL, null if unparsable."""
    return _facts(url, lambda g: F.when(g["valid"], g["host"]))


def is_crawlable(url) -> Column:
    """Non-empty, http(s), not a skipped extension."""
    def body(g):
        skip = F.regexp_extract(F.lower(g["path"]), r"(\.[^.]*)$", 1).isin(*SKIP_EXTENSIONS)
        return F.coalesce((g["s"] != "") & g["valid"] & g["scheme"].isin(*ALLOWED_SCHEMES) & ~skip,
                          F.lit(False))
    return _with_parts(url_parts(F.coalesce(_col(url), F.lit(""))), body)


def url_token_text(url) -> Column:
    """T4 input: host + path + query of a URL joined by spaces; null if unparsable."""
    return _facts(url, lambda g: F.when(
        g["valid"], F.concat_ws(" ", g["host"], g["path"], g["query"])))


def url_tokens(url) -> Column:
    """T4: tokens of host + path + query of a URL; unparsable -> []."""
    return _facts(url, lambda g: F.when(
        g["valid"], tokenize(F.concat_ws(" ", g["host"], g["path"], g["query"])))
        .otherwise(F.array().cast("array<string>")))


@lru_cache(maxsize=64)
def _built(application: str, fn, *names) -> Column:
    """fn over columns of these names. Building an expression of this size takes a
    second or two of calls into the JVM, so one application builds it once."""
    return fn(*[n if n is None else F.col(n) for n in names])


def with_normalized_url(df: DataFrame, raw: str, out: str, base: str | None = None) -> DataFrame:
    return df.withColumn(out, _built(df.sparkSession.sparkContext.applicationId, normalize_url, raw, base))


def with_url_facts(df: DataFrame, url: str, *, host: str | None = None, skip: str | None = None,
                   crawlable: str | None = None, tokens: str | None = None,
                   extension: str | None = None) -> DataFrame:
    """U3/U4/U5/T4 over column `url`, each written to the named column."""
    app = df.sparkSession.sparkContext.applicationId
    wanted = {host: hostname, skip: skip_by_extension, crawlable: is_crawlable, tokens: url_tokens,
              extension: globals()["extension"]}
    return df.withColumns({out: _built(app, fn, url) for out, fn in wanted.items() if out})
