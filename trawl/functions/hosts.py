"""URL hosts as Column expressions: percent-decoded and international names, IPv4
numbers, IPv6 addresses, as the WHATWG URL standard has them.

Names are mapped by lower case, full-width forms, ideographic full stops and ignored
characters, and labels with other than ASCII become punycode. Sequences of a letter
and combining marks are not composed, and no table of disallowed characters is kept.

Each function takes a plain column reference (a lambda variable or a column), since
it is used more than once, and gives null for a host that is not valid.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What no domain may hold; characters that the mapping drops.
FORBIDDEN_RE = r"[\x00-\x20#%/:<>?@\[\\\]^|\x7F\x{FFFD}]"
IGNORED_RE = r"[\x{AD}\x{34F}\x{180B}-\x{180D}\x{200B}\x{2060}\x{2064}\x{FE00}-\x{FE0F}\x{FEFF}]"
# Hosts that an IPv4 address could hide in: the last label is a number.
NUMBER_RE = r"(?:[^.]*\.)*(?:0[xX][0-9A-Fa-f]*|[0-9]+)\.?"
PLAIN_RE = r"^[A-Za-z0-9._~!$&'()*+,;=\-]+$"

# Fixed values of punycode.
_BASE, _TMIN, _TMAX, _SKEW, _DAMP, _BIAS, _FIRST = 36, 1, 26, 38, 700, 72, 128
_DIGITS = "abcdefghijklmnopqrstuvwxyz0123456789"

_WIDE = "".join(chr(0xFF01 + k) for k in range(94))
_NARROW = "".join(chr(0x21 + k) for k in range(94))


def bound(value: Column, use) -> Column:
    """use(value), with `value` computed once for all its uses."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _div(a: Column, b) -> Column:
    return F.floor(a / b).cast("long")


def _adapt(delta: Column, points: Column, first: Column) -> Column:
    start = F.when(first, _div(delta, _DAMP)).otherwise(_div(delta, 2))
    limit = (_BASE - _TMIN) * _TMAX // 2

    def shrink(s, _):
        return F.when(s["d"] > limit, F.struct(_div(s["d"], _BASE - _TMIN).alias("d"), (s["k"] + _BASE).alias("k"))).otherwise(s)

    def bias(start):
        zero = F.struct((start + _div(start, points)).alias("d"), F.lit(0).cast("long").alias("k"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(6)), zero, shrink,
                           lambda s: s["k"] + _div((_BASE - _TMIN + 1) * s["d"], s["d"] + _SKEW))

    return bound(start, bias)


def _digits(number: Column, bias: Column) -> Column:
    """A number as digits of variable weight, low first."""
    def step(s, k):
        t = F.least(F.greatest(k * _BASE - bias, F.lit(_TMIN).cast("long")), F.lit(_TMAX).cast("long"))
        more = F.struct(_div(s["q"] - t, _BASE - t).alias("q"),
                        F.concat(s["out"], F.substring(F.lit(_DIGITS), (t + (s["q"] - t) % (_BASE - t) + 1).cast("int"), F.lit(1))).alias("out"),
                        F.lit(False).alias("done"))
        last = F.struct(s["q"].alias("q"), F.concat(s["out"], F.substring(F.lit(_DIGITS), (s["q"] + 1).cast("int"), F.lit(1))).alias("out"),
                        F.lit(True).alias("done"))
        return F.when(s["done"], s).when(s["q"] < t, last).otherwise(more)

    zero = F.struct(number.alias("q"), F.lit("").alias("out"), F.lit(False).alias("done"))
    return F.aggregate(F.sequence(F.lit(1).cast("long"), F.lit(8).cast("long")), zero, step, lambda s: s["out"])


def punycode(label: Column) -> Column:
    """The punycode of a label (without `xn--`)."""
    points = F.transform(F.regexp_extract_all(label, F.lit("(?s)(.)"), 1), lambda c: F.ascii(c).cast("long"))

    def encode(points):
        basic = F.filter(points, lambda c: c < _FIRST)
        # The code points by size; around each a mark of its start (-1) and end (-2), between them all of the label.
        higher = F.array_sort(F.array_distinct(F.filter(points, lambda c: c >= _FIRST)))
        marks = [F.array(F.lit(m).cast("long")) for m in (-1, -2)]
        steps = F.flatten(F.transform(higher, lambda m: F.transform(
            F.concat(marks[0], points, marks[1]), lambda c: F.struct(m.alias("m"), c.alias("c")))))

        def state(delta, n, bias, h, out):
            return F.struct(delta.alias("delta"), n.alias("n"), bias.alias("bias"), h.alias("h"), out.alias("out"))

        def step(s, x):
            c, m = x["c"], x["m"]
            met = state(F.lit(0).cast("long"), s["n"], _adapt(s["delta"], s["h"] + 1, s["h"] == F.size(basic)), s["h"] + 1,
                        F.concat(s["out"], _digits(s["delta"], s["bias"])))
            return (F.when(c == -1, state(s["delta"] + (m - s["n"]) * (s["h"] + 1), m, s["bias"], s["h"], s["out"]))
                    .when(c == -2, state(s["delta"] + 1, s["n"] + 1, s["bias"], s["h"], s["out"]))
                    .when(c == m, met)
                    .when(c < m, state(s["delta"] + 1, s["n"], s["bias"], s["h"], s["out"])).otherwise(s))

        first = F.concat(F.array_join(F.transform(basic, lambda c: F.char(c)), ""), F.when(F.size(basic) > 0, "-").otherwise(""))
        zero = state(F.lit(0).cast("long"), F.lit(_FIRST).cast("long"), F.lit(_BIAS).cast("long"), F.size(basic).cast("long"), first)
        return F.aggregate(steps, zero, step, lambda s: s["out"])

    return bound(points, encode)


def _ascii_name(host: Column) -> Column:
    """Percent escapes decoded, mapped, labels in punycode."""
    broken = host.rlike("%(?![0-9A-Fa-f]{2})")
    decoded = (F.when(broken, F.lit(None).cast("string"))
               .when(host.contains("%"), F.try_url_decode(F.replace(host, F.lit("+"), F.lit("%2B")))).otherwise(host))
    mapped = F.lower(F.translate(F.regexp_replace(decoded, IGNORED_RE, ""), _WIDE + "。｡Σ", _NARROW + "..σ"))

    def labels(name):
        out = F.transform(F.split(name, r"\."), lambda x: F.when(x.rlike(r"[^\x00-\x7F]"), F.concat(F.lit("xn--"), punycode(x))).otherwise(x))
        return F.when(~name.rlike(FORBIDDEN_RE), F.array_join(out, "."))

    return bound(mapped, labels)


def ipv4(name: Column) -> Column:
    """The dotted address of a name whose last label is a number; null if it has
    more than four parts, an empty one, a digit that is none, or is too large."""
    def address(parts):
        def number(p):
            hex_, oct_ = F.substring(p, 3, 20), F.regexp_replace(p, "^0+", "")
            short = F.regexp_replace(hex_, "^0+", "")
            return (F.when(p.rlike("^0[xX][0-9A-Fa-f]*$"), F.when(F.length(short) <= 8, F.conv(F.concat(F.lit("0"), short), 16, 10)))
                    .when(p.rlike("^0[0-7]+$"), F.when(F.length(oct_) <= 11, F.conv(F.concat(F.lit("0"), oct_), 8, 10)))
                    .when(p.rlike("^(0|[1-9][0-9]{0,9})$"), p).cast("long"))

        def whole(n):
            k = F.size(n)
            low = F.element_at(n, -1)
            high = F.slice(n, 1, k - 1)
            value = F.aggregate(high, F.lit(0).cast("long"), lambda s, x: s * 256 + x) * F.pow(F.lit(256), 5 - k).cast("long") + low
            good = ((k <= 4) & F.forall(n, lambda x: x.isNotNull()) & F.forall(high, lambda x: x <= 255)
                    & (low < F.pow(F.lit(256), 5 - k).cast("long")))
            return F.when(good, bound(value, lambda v: F.array_join(F.array(
                *[(F.shiftright(v, s) % 256).cast("string") for s in (24, 16, 8, 0)]), ".")))

        return bound(F.transform(parts, number), whole)

    return bound(F.split(F.regexp_replace(name, r"\.$", ""), r"\."), address)


def ipv6(host: Column) -> Column:
    """The shortest form of an address in brackets."""
    inner = F.lower(F.regexp_extract(host, r"^\[(.*)\]$", 1))
    byte = "(?:0|[1-9][0-9]?|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"

    def without_ipv4(s):
        tail = F.regexp_extract(s, r"([^:]*)$", 1)

        def pair(a, b):
            return F.lower(F.hex(F.split(tail, r"\.")[a].cast("long") * 256 + F.split(tail, r"\.")[b].cast("long")))

        dotted = F.concat(F.regexp_extract(s, r"^(.*:)[^:]*$", 1), pair(0, 1), F.lit(":"), pair(2, 3))
        return F.when(~s.contains("."), s).when(s.rlike(rf"^.*:{byte}(?:\.{byte}){{3}}$"), dotted)

    def pieces(s):
        def side(x):
            return F.when(x == "", F.array().cast("array<string>")).otherwise(F.split(x, ":"))

        left, right = side(F.regexp_extract(s, "^(.*?)(?:::|$)", 1)), side(F.regexp_extract(s, "::(.*)$", 1))
        cut = s.contains("::")

        def eight(both):
            n = F.size(both["l"]) + F.size(both["r"])
            whole = F.concat(both["l"], F.array_repeat(F.lit("0"), F.when(cut, F.greatest(8 - n, F.lit(0))).otherwise(0)), both["r"])
            good = F.when(cut, n <= 7).otherwise(n == 8) & F.forall(whole, lambda p: p.rlike("^[0-9a-f]{1,4}$"))
            return F.when(good, F.concat(F.lit(":"), F.array_join(F.transform(whole, lambda p: F.regexp_replace(p, "^0+(?=.)", "")), ":"), F.lit(":")))

        return bound(F.struct(left.alias("l"), right.alias("r")), eight)

    def shortest(s):
        out = s
        for run in range(2, 9):   # the longest run of zeros, the first of them
            out = F.when(s.rlike(f":(?:0:){{{run}}}"), F.regexp_replace(s, f"^(.*?):(?:0:){{{run}}}", "$1::")).otherwise(out)
        return F.concat(F.lit("["), F.regexp_replace(out, "^:(?!:)|(?<!:):$", ""), F.lit("]"))

    return bound(bound(bound(inner, without_ipv4), pieces), shortest)


def parse_host(host: Column) -> Column:
    """The host of a special URL as it is written in the parsed URL, null if it has none."""
    def numbered(name):
        return (F.when((name == "") | name.rlike(FORBIDDEN_RE), F.lit(None).cast("string"))
                .when(name.rlike(f"^{NUMBER_RE}$"), ipv4(name)).otherwise(name))

    name = F.when(host.rlike(PLAIN_RE), F.lower(host)).otherwise(_ascii_name(host))
    return F.when(host.startswith("["), ipv6(host)).otherwise(bound(name, numbered))
