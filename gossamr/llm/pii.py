"""PII: patterns, and information-theoretic sanitisation of what surrounds them.

Protected entities are the distinct values that the patterns find, secrets (long tokens that carry much information of
their own, see secrets()) and, coarser, what values share: an e-mail address's domain, a number's or secret's prefix, the
kind. From the corpus it is estimated how much a term t tells about an entity e. Of IC(e) = -log2 p(e) bits an observer
of t is told PMI(t; e) = log2 p(e|t)/p(e); -log2 p(e|t) bits stay open. p(e) is taken over all distinct texts, and
p(e|t) over those that hold t: the share that hold it near e, drawn towards p(e) by `smoothing` imagined texts, so that
rare terms need no minimum count and one meeting alone (p at most one half) proves nothing. The disclosure of e by t is
p(e|t), where t tells at least `least_share` of IC(e); else, e being no surprise anyway, it is 0. Terms whose largest
disclosure reaches `remove_at` are removed, those that reach `generalise_at` are generalised, wherever they occur.
"""

from __future__ import annotations

import hashlib
import math
import operator
import re
from bisect import bisect_left
from collections import Counter
from itertools import accumulate

import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gossamr.llm.common import append, emit, field
from gossamr.session import fits, materialize, sized

#: Fixed patterns: the domain of an e-mail address after its @, IPv4 addresses, card numbers, telephone numbers.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
#: Kinds of spans, in the order that breaks ties of start.
KINDS = ("email", "ip", "card", "phone", "secret", "generalised", "removed")
#: Terms: words, names and numbers of at least two letters or digits.
WORD = re.compile(r"[^\W_]{2,}")
LETTER = re.compile(r"[^\W_]")
#: What a secret may consist of; bits of information and changes between letters and digits that it has at least.
TOKEN = re.compile(r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/=-]{16,}")
SECRET_BITS, CHANGES = 48, 4
#: A text without these characters has no base span and no secret.
HINT = "[@0-9]"
#: Terms that a worker's dictionary may hold; some 100 bytes each.
TERMS = 250_000


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _octet(digits: str) -> bool:
    """Whether digits, of any number, are at most 255."""
    own = digits.lstrip("0")
    return len(own) < 3 or len(own) == 3 and own <= "255"


def _emails(text: str) -> list[tuple[int, int]]:
    """Matches of [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+, found from each @ so that long runs cost no more."""
    found, end, at = [], 0, text.find("@")
    low = 0
    while at >= 0:
        head = text[max(low, end) : at]
        start = max(low, end) + len(head.rstrip(LOCAL))
        if start < at and (m := DOMAIN.match(text, at + 1)):
            found.append((start, m.end()))
            end = m.end()
        low = at + 1
        at = text.find("@", at + 1)
    return found


def base_spans(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of each base span, ordered by start, then kind."""
    if not text:
        return []
    out = [(s, e, "email") for s, e in _emails(text)]
    out += [(m.start(), m.end(), "ip") for m in IP.finditer(text) if all(_octet(x) for x in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and _luhn(digits):
            out.append((m.start(), m.end(), "card"))
    if "+" in text:
        out += [(m.start(), m.end(), "phone") for m in PHONE.finditer(text) if 10 <= sum(map(str.isdigit, m[0])) <= 15]
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


def information(token: str) -> float:
    """Bits of a token: its length times the entropy of its characters."""
    n = len(token)
    return sum(k * math.log2(n / k) for k in Counter(token).values())


def secrets(text: str, taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Spans of keys, hashes and the like outside the spans taken: tokens of 16 and more letters, digits and _+/=-, of at
    least SECRET_BITS bits, in which letters and digits change CHANGES times or more, as they do not in words and dates.
    """
    out = []
    for m in TOKEN.finditer(text):
        kinds = [c.isdigit() for c in m[0] if c.isalnum()]
        if sum(map(operator.ne, kinds, kinds[1:])) >= CHANGES and information(m[0]) >= SECRET_BITS and not any(s < m.end() and e > m.start() for s, e, _ in taken):
            out.append((m.start(), m.end(), "secret"))
    return out


def protected_spans(text: str | None) -> tuple[list, list]:
    """The base spans, and these and the secrets, each ordered by start, then kind."""
    base = base_spans(text)
    return base, sorted(base + secrets(text, base), key=lambda x: (x[0], KINDS.index(x[2]))) if text else base


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def entities(kind: str, value: str) -> list[int]:
    """Hashes of the value, of its domain or prefix, and of its kind."""
    value = value.lower() if kind in ("email", "ip") else value if kind == "secret" else "".join(filter(str.isdigit, value))
    shared = {"email": value.rpartition("@")[2], "ip": value.rpartition(".")[0], "card": value[:6], "phone": value[:-4], "secret": value[:4]}[kind]
    return [_signed(xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass"))) for x in (f"{kind}:{value}", f"{kind} of:{shared}", f"{kind}")]


def near_terms(text: str, spans: list[tuple[int, int, str]], window: int) -> set[tuple[int, str]]:
    """(entity, term) for the lower-cased words that lie wholly within `window` characters of a span, outside spans."""
    out = set()
    starts, reach = [s for s, _, _ in spans], list(accumulate((e for _, e, _ in spans), max))
    for s, e, kind in spans:
        who = entities(kind, text[s:e])
        for m in WORD.finditer(text, max(0, s - window), min(len(text), e + window)):
            cut = LETTER.match(text, m.start() - 1) if m.start() else None
            before = bisect_left(starts, m.end())
            if not cut and not LETTER.match(text, m.end()) and not (before and reach[before - 1] > m.start()):
                out.update((x, m[0].lower()) for x in who)
    return out


def contexts(docs: DataFrame, window: int) -> DataFrame:
    """Distinct (entity, term, fp) near spans, and a row with null term for each entity of a text; fp: the text's hash."""

    def start():
        def work(texts):
            rows = []
            for t in texts:
                if spans := protected_spans(t)[1]:
                    fp = _signed(xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")))
                    rows += [(e, None, fp) for e in {y for s, x, k in spans for y in entities(k, t[s:x])}]
                    rows += [(e, w, fp) for e, w in near_terms(t, spans, window)]
            return [list(x) for x in zip(*rows, strict=True)] if rows else [[], [], []]

        return work

    some = docs.filter(F.col("text").rlike(HINT)).select("text")
    return emit(some, ["text"], [field("entity", "long"), field("term", "string"), field("fp", "long")], start).distinct()


def term_counts(docs: DataFrame, candidates: DataFrame, broadcast_rows: int) -> DataFrame:
    """(term, docs): distinct texts that hold each candidate term. docs: text, copies (rows of the same text).

    Counted where the rows are, a row of n copies as 1/n, then summed.
    """
    known = docs.sparkSession.sparkContext.broadcast(frozenset(r.term for r in candidates.toLocalIterator())) if fits(candidates, limit=broadcast_rows) else None

    def start():
        counts: Counter = Counter()
        shares: Counter = Counter()

        def flush():
            for w, x in shares.items():
                counts[w] += x
            out = [list(counts.keys()), list(map(float, counts.values()))]
            counts.clear()
            shares.clear()
            return out

        def work(texts, copies):
            for t, n in zip(texts, copies, strict=True):
                if t:
                    words = set(WORD.findall(t.lower()))
                    words = words & known.value if known else words
                    if n == 1:
                        counts.update(words)
                    else:
                        for w in words:
                            shares[w] += 1 / n
            return flush() if len(counts) + len(shares) > TERMS else None

        return work, lambda: [flush()] if counts or shares else []

    counted = emit(docs, ["text", "copies"], [field("term", "string"), field("docs", "double")], start, finish=True)
    summed = counted.groupBy("term").agg(F.round(F.sum("docs")).cast("long").alias("docs"))
    return summed if known else summed.join(candidates, "term", "left_semi")


def disclosures(docs: DataFrame, window: int = 60, smoothing: float = 1.0, generalise_at: float = 0.6, least_share: float = 0.5, broadcast_rows: int = TERMS) -> DataFrame:
    """(term, entity, both, docs, with_entity, total, disclosure) of all pairs whose disclosure reaches generalise_at.

    All counts are of distinct texts, over all documents. Pairs that could not reach it even if the term occurred
    nowhere else are left out before their terms are counted.
    """
    texts = materialize(docs.filter("text is not null").groupBy(F.xxhash64("text").alias("_fp")).agg(F.count("*").alias("_n")), "pii-texts")
    total, repeated = texts.count(), texts.filter("_n > 1")
    met = materialize(contexts(docs, window), "pii-contexts")
    known = materialize(met.filter(F.col("term").isNull()).groupBy("entity").agg(F.count("*").alias("with_entity")), "pii-entities")
    pairs = met.filter(F.col("term").isNotNull()).groupBy("entity", "term").agg(F.count("*").alias("both")).join(sized(known), "entity").withColumn("total", F.lit(total).cast("long"))
    prior = F.col("with_entity") / F.col("total")
    posterior = lambda n: (F.col("both") + smoothing * prior) / (n + smoothing)
    pairs = materialize(pairs.filter(posterior(F.col("both")) >= generalise_at), "pii-pairs")
    candidates = materialize(pairs.select("term").distinct(), "pii-candidates")
    counted = docs.filter("text is not null").withColumn("_of", F.xxhash64("text")).join(sized(repeated), F.col("_of") == F.col("_fp"), "left")
    counts = term_counts(counted.select("text", F.coalesce("_n", F.lit(1).cast("long")).alias("copies")), candidates, broadcast_rows)
    share = F.log2(posterior(F.col("docs")) / prior) / -F.log2(prior)
    out = pairs.join(counts, "term").withColumn("disclosure", F.when((prior < 1) & (share >= least_share), posterior(F.col("docs"))).otherwise(0.0))
    return out.filter(F.col("disclosure") >= generalise_at).select("term", "entity", "both", "docs", "with_entity", "total", "disclosure")


def risky_terms(docs: DataFrame, window: int = 60, smoothing: float = 1.0, generalise_at: float = 0.6, remove_at: float = 0.75, least_share: float = 0.5, broadcast_rows: int = TERMS) -> DataFrame:
    """(term, action, disclosure) of terms whose disclosure of some entity reaches a threshold."""
    worst = disclosures(docs, window, smoothing, generalise_at, least_share, broadcast_rows).groupBy("term").agg(F.max("disclosure").alias("disclosure"))
    return worst.select("term", F.when(F.col("disclosure") >= remove_at, "removed").otherwise("generalised").alias("action"), "disclosure")


def all_spans(text: str | None, actions: dict[str, str]) -> tuple[list, list]:
    """Base spans, and all spans: these, secrets, and the risky terms outside them."""
    base, own = protected_spans(text)
    if not text or not actions or actions.keys().isdisjoint(WORD.findall(text.lower())):
        return base, own
    more, i, reach = [], 0, 0
    for m in WORD.finditer(text):
        if action := actions.get(m[0].lower()):
            while i < len(own) and own[i][0] < m.end():
                reach = max(reach, own[i][1])
                i += 1
            if reach <= m.start():
                more.append((m.start(), m.end(), action))
    return base, sorted(own + more, key=lambda x: (x[0], KINDS.index(x[2])))


def sanitised(text: str | None, spans: list[tuple[int, int, str]]) -> str | None:
    """text with base spans, secrets and generalised terms replaced by their kind in brackets and removed terms by nothing."""
    if not spans:
        return text
    out, at = [], 0
    for s, e, kind in spans:
        if s >= at:
            out += [text[at:s], "" if kind == "removed" else "[TERM]" if kind == "generalised" else f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, result, fields: list, window: int = 60, smoothing: float = 1.0, generalise_at: float = 0.6, remove_at: float = 0.75, least_share: float = 0.5, broadcast_rows: int = TERMS) -> DataFrame:
    """docs (text and any other columns) with fields appended: result(text, base spans, all spans) of each row.

    Risky terms are broadcast if at most broadcast_rows are counted; beyond, each row gets its own by a join. Null
    and empty texts have no spans. Repeated rows and copies of a text count as one text. An empty table gives an empty one. Columns with the name of a field
    are replaced.
    """
    terms = materialize(risky_terms(docs.select("text"), window, smoothing, generalise_at, remove_at, least_share, broadcast_rows), "pii-terms")
    if fits(terms, limit=broadcast_rows):
        known = docs.sparkSession.sparkContext.broadcast({r.term: r.action for r in terms.toLocalIterator()})

        def start():
            actions = known.value
            return lambda texts: [list(x) for x in zip(*[result(t, *all_spans(t, actions)) for t in texts], strict=True)]

        return append(docs, ["text"], fields, start)

    def words():
        def work(texts, keys):
            rows = [(k, w) for t, k in zip(texts, keys, strict=True) if t for w in set(WORD.findall(t.lower()))]
            return [list(x) for x in zip(*rows, strict=True)] if rows else [[], []]

        return work

    keyed = docs.withColumn("_key", F.xxhash64("text"))
    held = emit(keyed, ["text", "_key"], [field("_key", "long"), field("term", "string")], words).distinct()
    own = held.join(terms, "term").groupBy("_key").agg(F.collect_list("term").alias("_terms"), F.collect_list("action").alias("_actions"))

    def joined():
        return lambda texts, ts, acts: [list(x) for x in zip(*[result(t, *all_spans(t, dict(zip(a or [], b or [], strict=True)))) for t, a, b in zip(texts, ts, acts, strict=True)], strict=True)]

    return append(keyed.join(own, "_key", "left"), ["text", "_terms", "_actions"], fields, joined).drop("_key", "_terms", "_actions")


def listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for s, e, kind in spans)


def _digest(text, base, spans) -> tuple:
    kinds = Counter(k for _, _, k in base)
    return *(kinds[k] for k in KINDS[:4]), hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans), len(spans)


def redact(docs: DataFrame) -> DataFrame:
    """docs with text sanitised; all columns stay, n_chars follows the text where there is one.

    Every row stays: null and empty texts as they are, rows that repeat an id or a text each on its own.
    """
    out = sanitise(docs, lambda t, base, spans: (sanitised(t, spans),), [field("text", "string")])
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, counts of base spans, base_sha256, all spans and their number, for every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    fields = [field("n_email", "long"), field("n_ip", "long"), field("n_card", "long"), field("n_phone", "long"), field("base_sha256", "string"), field("spans", "string"), field("n_spans", "long")]
    return sanitise(docs, _digest, fields).drop("text")
