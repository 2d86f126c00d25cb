"""URL functions: Column -> Column, native expressions only, null for what is not a valid URL with a host.

parts() splits a URL once into a struct; the other functions take the struct or build it. Splitting follows RFC 3986
by way of Python's urlparse: surrounding blanks and inner tabs and line ends go, the scheme is lower-cased, and
;params are cut off the last path segment.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed set of characters that clean URLs keep as they are in path and query.
SAFE = r"A-Za-z0-9_.\-~/+%?&=$*()\[\]{},;:!|" + '"'
#: Fixed set that form encoding of parameters keeps.
FORM_SAFE = r"A-Za-z0-9_.\-~"
#: Characters that separate a URL's segments.
SEPARATORS = "[:/.?&=,;]"
_SPLIT = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def _let(value: Column, body) -> Column:
    """body(x) with x bound to value, so that a value used often is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def split(url: Column) -> Column:
    """Struct of scheme, netloc, path, params, query, fragment; every part is "" where it is missing."""

    def parse(u: Column) -> Column:
        path = F.regexp_extract(u, _SPLIT, 3)
        tail = F.regexp_extract(path, r"([^/]*)$", 1)
        cut = F.locate(";", tail)
        keep = F.when(cut > 0, F.length(path) - F.length(tail) + cut - 1).otherwise(F.length(path))
        return F.struct(
            F.lower(F.regexp_extract(u, _SPLIT, 1)).alias("scheme"),
            F.regexp_extract(u, _SPLIT, 2).alias("netloc"),
            F.substring(path, F.lit(1), keep).alias("path"),
            F.when(cut > 0, F.substring(tail, cut + 1, F.length(tail))).otherwise("").alias("params"),
            F.regexp_extract(u, _SPLIT, 4).alias("query"),
            F.regexp_extract(u, _SPLIT, 5).alias("fragment"),
        )

    return _let(F.translate(F.trim(url, F.lit(" \t\n\r\f\x0b")), "\t\r\n", ""), parse)


def _authority(netloc: Column) -> Column:
    """netloc without user information."""
    return F.regexp_extract(netloc, r"([^@]*)$", 1)


def host_of(p: Column) -> Column:
    """Lower-cased host name of split(); null without one, or with a broken port or IPv6 address."""
    authority = _authority(p["netloc"])
    host = F.regexp_extract(authority, r"^(\[[0-9A-Fa-f:.]+\]|[^:\[\]]+)(?::[0-9]*)?$", 1)
    port = F.regexp_extract(authority, r":([0-9]*)$", 1)
    ok = (host != "") & ((port == "") | (F.length(port) <= 5) & (port.try_cast("int") <= 65535))
    return F.when(ok, F.lower(F.translate(host, "[]", "")))


def host(url: Column) -> Column:
    return _let(split(url), host_of)


def canonical_host(name: Column, match_domain: bool = False) -> Column:
    """The host itself, or its last two labels."""
    return F.substring_index(name, ".", -2) if match_domain else name


def netloc_of(p: Column) -> Column:
    """netloc of split(); where it is a host with the scheme's explicit default port, the lower-cased host alone."""
    default = ((p["scheme"] == "http") & p["netloc"].rlike(":0*80$")) | ((p["scheme"] == "https") & p["netloc"].rlike(":0*443$"))
    plain = ~F.contains(p["netloc"], F.lit("@"))
    return F.when(default & plain, F.lower(F.regexp_replace(p["netloc"], r":[0-9]+$", ""))).otherwise(p["netloc"])


def _encode(text: Column, safe: str, space: str) -> Column:
    def one(c: Column) -> Column:
        code = F.regexp_replace(F.hex(F.encode(c, "UTF-8")), "(..)", "%$1")
        return F.when(c == " ", space).when(c.rlike(f"[{safe}]"), c).otherwise(code)

    slow = F.array_join(F.transform(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), one), "")
    return F.when(text.rlike(f"[^{safe}]"), slow).otherwise(text)


def normalize(component: Column) -> Column:
    """Percent-encode what is not safe in a path or query; spaces, encoded ones too, become +."""
    return F.replace(_encode(component, SAFE, "+"), F.lit("%20"), F.lit("+"))


def unsplit(scheme: Column, netloc: Column, path: Column, params: Column, query: Column, fragment: Column | None = None) -> Column:
    """Put a URL with a netloc together; empty params, query and fragment leave no trace."""
    rooted = F.when((path == "") | F.startswith(path, F.lit("/")), path).otherwise(F.concat(F.lit("/"), path))
    rooted = F.when((path == "") & (params != ""), "/").otherwise(rooted)
    tail = [F.when(params != "", F.concat(F.lit(";"), params)).otherwise(""), F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")]
    if fragment is not None:
        tail.append(F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(""))
    return F.concat(scheme, F.lit("://"), netloc, rooted, *tail)


def _with_host(url: Column, build) -> Column:
    return _let(split(url), lambda p: F.when(host_of(p).isNotNull() & (p["scheme"] != ""), build(p)))


def clean_of(p: Column) -> Column:
    """clean() of split()."""
    return F.when(host_of(p).isNotNull() & (p["scheme"] != ""), unsplit(p["scheme"], netloc_of(p), normalize(p["path"]), p["params"], normalize(p["query"])))


def clean(url: Column) -> Column:
    """The clean URL: path and query normalized, fragment dropped, params as they are."""
    return _let(split(url), clean_of)


def host_and_clean(url: Column) -> Column:
    """Struct of host and clean, from one split."""
    return _let(split(url), lambda p: F.struct(host_of(p).alias("host"), clean_of(p).alias("clean")))


def clean_redirect(url: Column) -> Column:
    """As clean, but path and query are not encoded anew."""
    return _with_host(url, lambda p: unsplit(p["scheme"], netloc_of(p), p["path"], p["params"], p["query"]))


def head(url: Column) -> Column:
    """The URL without query and fragment."""
    return _with_host(url, lambda p: unsplit(p["scheme"], netloc_of(p), p["path"], p["params"], F.lit("")))


def query(url: Column) -> Column:
    return _let(split(url), lambda p: p["query"])


def scheme(url: Column) -> Column:
    return _let(split(url), lambda p: p["scheme"])


def _decode(text: Column) -> Column:
    """Form decoding: + is a space, escapes are UTF-8; ill-formed sequences become U+FFFD."""

    def run(escapes: Column) -> Column:
        return F.when(F.startswith(escapes, F.lit("%")), F.make_valid_utf8(F.unhex(F.translate(escapes, "%", "")).cast("string"))).otherwise(escapes)

    pieces = F.regexp_extract_all(F.translate(text, "+", " "), F.lit(r"(?s)(?:%[0-9A-Fa-f]{2})+|%|[^%]+"), F.lit(0))
    hard = F.array_join(F.transform(pieces, lambda x: F.when(x == "%", x).otherwise(run(x))), "")
    return F.when(text.rlike("[%]"), hard).otherwise(F.translate(text, "+", " "))


def param_set(query_text: Column) -> Column:
    """The parameters of a query, as a sorted array of one string for each name: n=v1&n=v2, form-encoded.

    Blank values and pieces without = are dropped.
    """
    pieces = F.filter(F.split(query_text, "&"), lambda x: x.rlike("(?s)^[^=]*=."))
    pairs = F.transform(pieces, lambda x: F.struct(_decode(F.substring_index(x, "=", 1)).alias("n"), _decode(F.substring(x, F.locate("=", x) + 1, F.length(x))).alias("v")))

    def grouped(many: Column) -> Column:
        names = F.array_distinct(F.transform(many, lambda x: x["n"]))

        def one(name: Column) -> Column:
            own = F.filter(many, lambda x: x["n"] == name)
            return F.array_join(F.transform(own, lambda x: F.concat(_encode(x["n"], FORM_SAFE, "+"), F.lit("="), _encode(x["v"], FORM_SAFE, "+"))), "&")

        return F.array_sort(F.transform(names, one))

    return _let(pairs, grouped)


def simplify(url: Column, blacklist: Column | list[str] | None = None) -> Column:
    """The clean URL without parameters in the blacklist, the others sorted; a URL without query stays as it is."""
    names = F.array(*map(F.lit, blacklist)) if isinstance(blacklist, list) and blacklist else blacklist if isinstance(blacklist, Column) else None

    def build(p: Column) -> Column:
        params = param_set(p["query"])
        kept = F.array_except(params, names) if names is not None else params
        return unsplit(p["scheme"], p["netloc"], p["path"], p["params"], F.array_join(F.array_sort(kept), "&"))

    return F.when(F.contains(url, F.lit("?")), _let(split(url), build)).otherwise(url)


def segments(url: Column) -> Column:
    """Non-empty pieces of a URL after its scheme."""
    pieces = F.split(url, SEPARATORS)
    return F.filter(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), lambda x: x != "")


def resolve(base: Column, href: Column) -> Column:
    """The absolute URL of a reference found on the page base (RFC 3986, with Python's urljoin deciding what is open)."""

    def fold(raw: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            up = F.when(F.size(acc) > 0, F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(acc)
            return F.when(x == "..", up).when(x == ".", acc).otherwise(F.array_append(acc, x))

        last = F.element_at(raw, -1)
        done = F.aggregate(raw, F.array().cast("array<string>"), step)
        joined = F.array_join(F.when((last == "..") | (last == "."), F.array_append(done, F.lit(""))).otherwise(done), "/")
        return F.when(joined == "", "/").otherwise(joined)

    def build(b: Column, h: Column) -> Column:
        folder = F.regexp_replace(b["path"], "[^/]*$", "")
        merged = F.when(F.startswith(h["path"], F.lit("/")), h["path"]).otherwise(F.regexp_replace(F.concat(F.when(folder == "", "/").otherwise(folder), h["path"]), "/{2,}", "/"))
        same = (h["path"] == "") & (h["params"] == "")
        path = F.when(same, b["path"]).otherwise(fold(F.split(merged, "/")))
        params = F.when(same, b["params"]).otherwise(h["params"])
        q = F.when(same & (h["query"] == ""), b["query"]).otherwise(h["query"])
        return unsplit(b["scheme"], b["netloc"], path, params, q, h["fragment"])

    def choose(b: Column, h: Column) -> Column:
        absolute = (h["scheme"] != "") & ((h["scheme"] != b["scheme"]) | (h["netloc"] != ""))
        onto = F.when(h["netloc"] != "", unsplit(b["scheme"], h["netloc"], h["path"], h["params"], h["query"], h["fragment"]))
        return F.when(href == "", base).when(absolute, F.trim(href)).otherwise(F.coalesce(onto, build(b, h)))

    return F.when(base.isNull() | href.isNull(), None).otherwise(_let(split(base), lambda b: _let(split(href), lambda h: choose(b, h))))
