"""DuckDB SQL re-statements of the column rules, used to build the oracle
queries that the driver runs next to the Spark plans.

They are written independently of the Spark code (different engine, RE2
regexes, `list_*` lambdas) and cover the URL forms that occur in the driver
tables: absolute http(s) URLs with port, query and fragment, and root-relative,
network-path, query-only, fragment-only and plain relative hrefs.
"""
from __future__ import annotations

# The rules, stated again: nothing here comes from the code that it checks.
# Whitespace of JavaScript, limits, patterns, stop words, extensions.
JS_WS = r"[\t-\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
TITLE_MAX_CHARS, TEXT_MAX_CHARS = 500, 100000
TITLE_RE = r"(?i)<title[^>]*>([\s\S]*?)</title>"
LINK_RE = rf"(?i)<a{JS_WS}[^>]*href{JS_WS}*={JS_WS}*[\x22\x27]([^\x22\x27]*?)[\x22\x27][^>]*>"
DROPPED = [r"(?i)<script[\s\S]*?</script>", r"(?i)<style[\s\S]*?</style>", r"(?i)<noscript[\s\S]*?</noscript>",
           r"<!--[\s\S]*?-->", r"<[^>]+>"]
STOP_WORDS = """
a an the and or but in on at to for of with by from is it as be was were are been being have has had do does did will
would could should may might shall can this that these those i you he she we they me him her us them my your his its our
their not no so if up out about into than then just all also how what when where who which why each every both few more
most other some such only own same too very
""".split()
SKIP_EXTENSIONS = """.png .jpg .jpeg .gif .svg .webp .ico .pdf .zip .tar .gz .rar .7z .mp3 .mp4 .avi .mov .wmv .flv
.css .js .json .xml .rss .atom .woff .woff2 .ttf .eot .exe .dmg .msi .apk""".split()

STOP_SQL = ", ".join(f"'{w}'" for w in STOP_WORDS)
SKIP_SQL = ", ".join(f"'{e}'" for e in SKIP_EXTENSIONS)


def trim_js(x: str) -> str:
    return f"regexp_replace({x}, '^{JS_WS}+|{JS_WS}+$', '', 'g')"


def decode(x: str) -> str:
    out = x
    for ent, ch in (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"),
                    ("&apos;", "''")):
        out = f"replace({out}, '{ent}', '{ch}')"
    out = (f"array_to_string(list_transform(regexp_extract_all({out}, '((?s)&#[0-9]+;|[^&]+|&)', 1), "
           f"lambda p: CASE WHEN regexp_full_match(p, '&#[0-9]+;') "
           f"THEN chr(CAST(CAST(regexp_extract(p, '[0-9]+') AS DOUBLE) % 65536 AS INTEGER)) ELSE p END), '')")
    out = (f"array_to_string(list_transform(regexp_extract_all({out}, '((?s)&#x[0-9a-fA-F]+;|[^&]+|&)', 1), "
           f"lambda p: CASE WHEN regexp_full_match(p, '&#x[0-9a-fA-F]+;') "
           f"THEN chr(CAST(('0x' || right(lpad(regexp_extract(p, '&#x([0-9a-fA-F]+);', 1), 4, '0'), 4)) AS INTEGER)) "
           f"ELSE p END), '')")
    return f"replace({out}, '&nbsp;', ' ')"


def title(html: str) -> str:
    inner = f"regexp_extract(coalesce({html}, ''), '{TITLE_RE}', 1)"
    return f"left({trim_js(decode(inner))}, {TITLE_MAX_CHARS})"


def body_text(html: str) -> str:
    t = f"coalesce({html}, '')"
    for pat in DROPPED:
        t = f"regexp_replace({t}, '{pat}', ' ', 'g')"
    t = decode(t)
    t = trim_js(f"regexp_replace({t}, '{JS_WS}+', ' ', 'g')")
    return f"left({t}, {TEXT_MAX_CHARS})"


def links(html: str) -> str:
    raw = f"list_transform(regexp_extract_all(coalesce({html}, ''), '{LINK_RE}', 1), lambda h: {trim_js('h')})"
    ne = f"list_filter({raw}, lambda h: h <> '')"
    return f"list_filter({ne}, lambda x, i: list_position({ne}, x) = i)"


def tokens(x: str) -> str:
    return (f"list_filter(string_split_regex(lower(coalesce({x}, '')), '[^a-z0-9]+'), "
            f"lambda t: length(t) >= 2 AND t NOT IN ({STOP_SQL}))")


def _form_enc(x: str) -> str:
    return f"replace(replace(replace(url_encode({x}), '%20', '+'), '%2A', '*'), '~', '%7E')"


def _form_dec(x: str) -> str:
    return f"url_decode(replace({x}, '+', ' '))"


def pct_path(p: str) -> str:
    return (f"array_to_string(list_transform(string_split({p}, ''), lambda c: CASE WHEN "
            f"regexp_matches(c, '[^\\x21-\\x7E]|[\\x22<>\\x60{{}}]') THEN "
            f"regexp_replace(hex(encode(c)), '(..)', '%\\1', 'g') ELSE c END), '')")


def sorted_query(q: str) -> str:
    parts = f"list_filter(string_split({q}, '&'), lambda s: s <> '')"
    name = _form_dec("regexp_extract(s, '^([^=]*)', 1)")
    value = _form_dec("regexp_extract(s, '^[^=]*=?(.*)$', 1)")
    pairs = f"list_transform({parts}, lambda s, i: struct_pack(name := {name}, pos := i, value := {value}))"
    ser = f"list_transform(list_sort({pairs}), lambda kv: {_form_enc('kv.name')} || '=' || {_form_enc('kv.value')})"
    return f"array_to_string({ser}, '&')"


def url_ctes(src: str, raw: str, out: str, base: str | None, prefix: str) -> list[tuple[str, str]]:
    """CTE chain adding column `out` (normalized URL or NULL) to relation `src`."""
    p = prefix
    ctes = []
    s_expr = f"regexp_replace(regexp_replace({raw}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g'), '[\\t\\n\\r]', '', 'g')"
    abs_re = "^([A-Za-z][A-Za-z0-9+.\\-]*):(.*)$"
    base_cols = ""
    if base is not None:
        base_cols = (f", lower(regexp_extract({base}, '{abs_re}', 1)) AS {p}bscheme"
                     f", regexp_extract(regexp_replace(regexp_extract({base}, '{abs_re}', 2), '^/*', ''), '^([^/?#]*)', 1) AS {p}bauth"
                     f", regexp_extract(regexp_extract(regexp_replace(regexp_extract({base}, '{abs_re}', 2), '^/*', ''), '^[^/?#]*(.*)$', 1), '^([^?#]*)', 1) AS {p}bpath"
                     f", regexp_extract(regexp_replace(regexp_extract({base}, '{abs_re}', 2), '^/*', ''), '\\?([^#]*)', 1) AS {p}bquery"
                     f", regexp_matches(regexp_replace(regexp_extract({base}, '{abs_re}', 2), '^/*', ''), '^[^?#]*\\?') AS {p}bhq")
    ctes.append((f"{p}1", f"SELECT *, {s_expr} AS {p}s{base_cols} FROM {src}"))
    s = f"{p}s"
    ascheme = f"lower(regexp_extract({s}, '{abs_re}', 1))"
    arest = f"regexp_replace(regexp_extract({s}, '{abs_re}', 2), '^[/\\\\]*', '')"
    if base is None:
        kind = f"CASE WHEN regexp_matches({s}, '^[A-Za-z][A-Za-z0-9+.\\-]*:') THEN 'abs' ELSE 'bad' END"
    else:
        kind = (f"CASE WHEN regexp_matches({s}, '^[A-Za-z][A-Za-z0-9+.\\-]*:') THEN 'abs' "
                f"WHEN {p}bscheme NOT IN ('http','https') THEN 'bad' "
                f"WHEN starts_with({s}, '//') THEN 'net' WHEN starts_with({s}, '/') THEN 'root' "
                f"WHEN starts_with({s}, '?') THEN 'query' WHEN starts_with({s}, '#') OR {s} = '' THEN 'frag' "
                f"ELSE 'rel' END")
    ctes.append((f"{p}2", f"SELECT *, {kind} AS {p}kind, {ascheme} AS {p}ascheme, {arest} AS {p}arest FROM {p}1"))
    net_rest = f"regexp_replace({s}, '^//', '')"
    if base is None:
        scheme = f"{p}ascheme"
        auth = f"regexp_extract({p}arest, '^([^/?#]*)', 1)"
        after = f"regexp_extract({p}arest, '^[^/?#]*(.*)$', 1)"
        path0 = f"regexp_extract({after}, '^([^?#]*)', 1)"
        query = f"regexp_extract({after}, '^[^?#]*\\?([^#]*)', 1)"
        hq = f"regexp_matches({after}, '^[^?#]*\\?')"
    else:
        k = f"{p}kind"
        a_after = f"regexp_extract({p}arest, '^[^/?#]*(.*)$', 1)"
        n_after = f"regexp_extract({net_rest}, '^[^/?#]*(.*)$', 1)"
        bdir = f"regexp_extract({p}bpath, '^(.*/)', 1)"
        scheme = f"CASE WHEN {k} = 'abs' THEN {p}ascheme WHEN {k} = 'bad' THEN '' ELSE {p}bscheme END"
        auth = (f"CASE WHEN {k} = 'abs' THEN regexp_extract({p}arest, '^([^/?#]*)', 1) "
                f"WHEN {k} = 'net' THEN regexp_extract({net_rest}, '^([^/?#]*)', 1) "
                f"WHEN {k} = 'bad' THEN NULL ELSE {p}bauth END")
        path0 = (f"CASE WHEN {k} = 'abs' THEN regexp_extract({a_after}, '^([^?#]*)', 1) "
                 f"WHEN {k} = 'net' THEN regexp_extract({n_after}, '^([^?#]*)', 1) "
                 f"WHEN {k} = 'root' THEN regexp_extract({s}, '^([^?#]*)', 1) "
                 f"WHEN {k} IN ('query', 'frag') THEN {p}bpath "
                 f"WHEN {k} = 'rel' THEN (CASE WHEN {bdir} = '' THEN '/' ELSE {bdir} END) || regexp_extract({s}, '^([^?#]*)', 1) "
                 f"ELSE '' END")
        query = (f"CASE WHEN {k} = 'abs' THEN regexp_extract({a_after}, '^[^?#]*\\?([^#]*)', 1) "
                 f"WHEN {k} = 'net' THEN regexp_extract({n_after}, '^[^?#]*\\?([^#]*)', 1) "
                 f"WHEN {k} = 'frag' THEN {p}bquery ELSE regexp_extract({s}, '^[^?#]*\\?([^#]*)', 1) END")
        hq = (f"CASE WHEN {k} = 'abs' THEN regexp_matches({a_after}, '^[^?#]*\\?') "
              f"WHEN {k} = 'net' THEN regexp_matches({n_after}, '^[^?#]*\\?') "
              f"WHEN {k} = 'frag' THEN {p}bhq ELSE regexp_matches({s}, '^[^?#]*\\?') END")
    ctes.append((f"{p}3", f"SELECT *, {scheme} AS {p}scheme, {auth} AS {p}auth, {path0} AS {p}path0, "
                          f"{query} AS {p}query, {hq} AS {p}hq FROM {p}2"))
    hostport = f"regexp_extract({p}auth, '^(?:.*@)?(.*)$', 1)"
    ctes.append((f"{p}4", f"SELECT *, lower(regexp_extract({hostport}, '^([^:]*)', 1)) AS {p}host, "
                          f"regexp_extract({hostport}, '^[^:]*:(.*)$', 1) AS {p}port, "
                          f"CASE WHEN {p}path0 = '' THEN '/' ELSE replace({p}path0, '\\', '/') END AS {p}path1 FROM {p}3"))
    port = (f"CASE WHEN {p}port = '' THEN '' WHEN ({p}scheme = 'http' AND CAST({p}port AS INTEGER) = 80) "
            f"OR ({p}scheme = 'https' AND CAST({p}port AS INTEGER) = 443) THEN '' "
            f"ELSE ':' || CAST(CAST({p}port AS INTEGER) AS VARCHAR) END")
    path = f"{pct_path(p + 'path1')}"
    path_trim = f"CASE WHEN length({p}path2) > 1 AND ends_with({p}path2, '/') THEN left({p}path2, length({p}path2) - 1) ELSE {p}path2 END"
    q = f"CASE WHEN {p}hq THEN {sorted_query(p + 'query')} ELSE '' END"
    valid = (f"({p}kind <> 'bad' AND {p}scheme IN ('http', 'https') AND {p}auth IS NOT NULL AND {p}host <> '' "
             f"AND NOT regexp_matches({p}host, '[\\x00-\\x20#%/:<>?@\\[\\\\\\]^|\\x7F]') "
             f"AND ({p}port = '' OR regexp_full_match({p}port, '[0-9]{{1,5}}')) "
             f"AND {s} <> '' AND NOT regexp_matches({s}, '(?i)^(mailto:|javascript:|tel:|data:|ftp:)'))")
    ctes.append((f"{p}5", f"SELECT *, {path} AS {p}path2, {port} AS {p}portout, {q} AS {p}q FROM {p}4"))
    ctes.append((f"{p}6", f"SELECT * EXCLUDE ({p}s, {p}kind, {p}ascheme, {p}arest, {p}scheme, {p}auth, {p}path0, "
                          f"{p}query, {p}hq, {p}host, {p}port, {p}path1, {p}path2, {p}portout, {p}q"
                          + (f", {p}bscheme, {p}bauth, {p}bpath, {p}bquery, {p}bhq" if base is not None else "")
                          + f"), CASE WHEN {valid} THEN {p}scheme || '://' || {p}host || {p}portout || ({path_trim}) || "
                            f"CASE WHEN {p}q <> '' THEN '?' || {p}q ELSE '' END END AS {out} FROM {p}5"))
    return ctes


def url_facts(url: str) -> dict[str, str]:
    """Host, path, query of an absolute normalized URL (no base)."""
    rest = f"regexp_replace(regexp_extract({url}, '^[A-Za-z][A-Za-z0-9+.\\-]*:(.*)$', 1), '^/*', '')"
    host = f"lower(regexp_extract(regexp_extract({rest}, '^([^/?#]*)', 1), '^(?:.*@)?([^:]*)', 1))"
    after = f"regexp_extract({rest}, '^[^/?#]*(.*)$', 1)"
    path = f"regexp_extract({after}, '^([^?#]*)', 1)"
    query = f"regexp_extract({after}, '^[^?#]*\\?([^#]*)', 1)"
    return {"host": host, "path": f"(CASE WHEN {path} = '' THEN '/' ELSE {path} END)", "query": query}


def url_tokens(url: str) -> str:
    f = url_facts(url)
    return tokens(f"concat_ws(' ', {f['host']}, {f['path']}, {f['query']})")


def skip_ext(url: str) -> str:
    f = url_facts(url)
    return f"coalesce(regexp_extract(lower({f['path']}), '(\\.[^.]*)$', 1) IN ({SKIP_SQL}), true)"


def with_ctes(ctes: list[tuple[str, str]], final: str) -> str:
    import re

    recursive = any(re.search(rf"\b(FROM|JOIN) {n}\b", q) for n, q in ctes)
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(f"{n} AS ({q})" for n, q in ctes) + "\n" + final
