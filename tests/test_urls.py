import random
import re
from urllib.parse import unquote_plus, urljoin, urlparse

from pyspark.sql import functions as F

import spec
from gossamr.functions import urls

HOSTS = ["Ex.com", "a.b.C.org:80", "a.org:443", "u:p@h.de", "u@h.de:80", "h.cz:8080", "h:", "x.y"]
PIECES = ["a", "B", ".", "..", "é", "%20", " ", "+", "b;c", "d;e=1", "%C3%A9", "%ff", "x|y", "<", "^", "", '"', "'", "a,b", "1", "🎉", "%"]


def _urls(n, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        path = "/".join(rng.choice(PIECES) for _ in range(rng.randint(0, 4)))
        query = "&".join(rng.choice(["a", "b", "c%20d", "é", "x"]) + rng.choice(["=", "", "=="]) + rng.choice(PIECES) for _ in range(rng.randint(0, 4)))
        out.append(rng.choice(["http", "https", "HTTP"]) + "://" + rng.choice(HOSTS) + ("/" + path if rng.random() < 0.8 else "") + ("?" + query if rng.random() < 0.6 else "") + rng.choice(["", "", "#f"]))
    return out


#: Raw URLs and their clean form, worked out by hand.
CLEAN = [
    ("http://Ex.com/a b", "http://Ex.com/a+b"),
    ("http://a.b.C.org:80/x", "http://a.b.c.org/x"),
    ("HTTPS://A.org:443/?", "https://a.org/"),
    ("https://A.org:80/", "https://A.org:80/"),
    ("https://U:p@H.de:443/a", "https://U:p@H.de:443/a"),
    ("http://h.cz:8080/é", "http://h.cz:8080/%C3%A9"),
    ("http://h/a%20b?x=%20y", "http://h/a+b?x=+y"),
    ("http://h/a;b;c?d;e", "http://h/a;b;c?d;e"),
    ("http://h/;p q", "http://h/;p q"),
    ("http://h/x#f", "http://h/x"),
    ("http://h/#", "http://h/"),
    ("http://h", "http://h"),
    ("  http://a.b/ ", "http://a.b/"),
    ("http://h/'@<>^\\`", "http://h/%27%40%3C%3E%5E%5C%60"),
    ("http://h/🎉?q=🎉", "http://h/%F0%9F%8E%89?q=%F0%9F%8E%89"),
    ('http://h/a|b"c', 'http://h/a|b"c'),
    ("http://h/%zz%", "http://h/%zz%"),
    ("http://h/a+b~c_d.e-f", "http://h/a+b~c_d.e-f"),
    ("http://h/%C3%A9%ff", "http://h/%C3%A9%ff"),
    ("http://h/./../x//y", "http://h/./../x//y"),
    ("mailto:a@b.c", None), ("/x", None), ("", None), ("#only", None), ("http://[::1", None), ("http://h:bad/", None), ("http://h:99999/", None),
]


def test_clean_urls_are_those_worked_out_by_hand(spark):
    df = spark.createDataFrame([(raw,) for raw, _ in CLEAN], "u string")
    got = {r.u: r.c for r in df.select("u", urls.clean(F.col("u")).alias("c")).collect()}
    assert got == dict(CLEAN)


def test_clean_keeps_what_a_url_means_and_is_idempotent(spark):
    """Of any URL: the same decoded path and query, no fragment, plain characters only, and nothing more to clean."""
    df = spark.createDataFrame([(u,) for u in _urls(1500, 5)], "u string").select("u", urls.clean(F.col("u")).alias("c"))
    for r in df.withColumn("again", urls.clean(F.col("c"))).collect():
        old, new = urlparse(r.u.strip()), urlparse(r.c)
        assert (unquote_plus(new.path), new.params, unquote_plus(new.query), new.fragment) == (unquote_plus(old.path), old.params, unquote_plus(old.query), "")
        assert (new.scheme, new.hostname) == (old.scheme, old.hostname) and r.again == r.c
        assert re.fullmatch(r"""[!-~]*""", new.path + new.query) and not re.search(r"[<>^`'@\\]|%20", new.path + new.query)


def test_params_and_simplified_urls_match_the_standard_library(spark):
    df = spark.createDataFrame([(u,) for u in _urls(1500, 5)], "u string")
    for r in df.select("u", urls.clean(F.col("u")).alias("c"), urls.param_set(urls.query(F.col("u"))).alias("p"), urls.simplify(urls.clean(F.col("u"))).alias("s")).collect():
        assert r.p == spec.param_set(urlparse(r.u.strip()).query) and r.s == spec.simplify(r.c), r.u


def test_simplify_is_idempotent(spark):
    df = spark.createDataFrame([(u,) for u in _urls(500, 8)], "u string").select(urls.simplify(urls.clean(F.col("u")), ["a=a", "b=1"]).alias("s"))
    assert df.filter(~urls.simplify(F.col("s"), ["a=a", "b=1"]).eqNullSafe(F.col("s"))).count() == 0


def test_resolve_matches_urljoin(spark):
    rng = random.Random(3)
    bases = [u for u in _urls(1500, 9) if not u.endswith(" ")]
    hrefs = [rng.choice(["", "/", "//other.org/", "./", "../", "?q=1", "#z"]) + "/".join(rng.choice(PIECES[:-1]) for _ in range(rng.randint(0, 4))) for _ in bases]
    df = spark.createDataFrame(list(zip(bases, hrefs, strict=True)), "b string, h string")
    for r in df.select("b", "h", urls.resolve(F.col("b"), F.col("h")).alias("r")).collect():
        assert r.r == urljoin(r.b, r.h.strip()), (r.b, r.h)


def test_segments_hosts_and_nulls(spark):
    df = spark.createDataFrame([("http://A.b.co/x//y.z?k=1,2;3",), (None,)], "u string")
    one, none = df.select(urls.segments(F.col("u")).alias("g"), urls.host(F.col("u")).alias("h"), urls.canonical_host(urls.host(F.col("u")), True).alias("d"), urls.head(F.col("u")).alias("e"), urls.clean_redirect(F.col("u")).alias("r")).collect()
    assert one.g == [x for x in re.split("[:/.?&=,;]", "http://A.b.co/x//y.z?k=1,2;3")[1:] if x]
    assert (one.h, one.d, one.e) == ("a.b.co", "b.co", "http://A.b.co/x//y.z")
    assert none.h is None and none.e is None and none.r is None
