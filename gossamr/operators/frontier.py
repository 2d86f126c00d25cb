"""The crawl frontier: filters, admission, priorities, scheduling, seeds, retries.

The order of links, that a crawler has by working one by one, is explicit: seq columns (page, place on it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gossamr.functions import urls
from gossamr.operators import tables
from gossamr.operators.scan import bounds, scanned
from gossamr.session import materialize, sized
from gossamr.sources.options import Options


def whitelist(tops: DataFrame, match_domain: bool = False, host_inst: DataFrame | None = None, instance_id: int | None = None) -> DataFrame:
    """(canonical, host_id) of the allowed hosts; of hosts with one canonical name the largest id counts."""
    if instance_id is not None and host_inst is not None:
        tops = tops.join(host_inst.filter(F.col("instance_id") == instance_id).select(F.col("host_id").alias("id")), "id", "left_semi")
    return tops.groupBy(urls.canonical_host(F.col("hostname"), match_domain).alias("canonical")).agg(F.max("id").alias("host_id"))


def check_hosts(links: DataFrame, tops: DataFrame, match_domain: bool = False, link: str = "link") -> DataFrame:
    """links with host and host_id; null where there is no host, or none that is allowed."""
    return _known_hosts(links.withColumn("host", urls.host(F.col(link))), tops, match_domain)


def _known_hosts(links: DataFrame, tops: DataFrame, match_domain: bool) -> DataFrame:
    known = whitelist(tops, match_domain).withColumnRenamed("canonical", "_canonical")
    return links.withColumn("_canonical", urls.canonical_host(F.col("host"), match_domain)).join(sized(known), "_canonical", "left").drop("_canonical")


def skip_reason(url: Column, options: Options = Options()) -> Column:
    """The first rule that a clean URL fails, or null."""
    reason = F.lit(None).cast("string")
    reason = F.when(F.length(url) > options.max_url_len, "too long").otherwise(reason)
    if options.url_blacklist_rx:
        reason = F.when(url.rlike(f"(?i){options.url_blacklist_rx}"), "blacklisted").otherwise(reason)
    if options.url_whitelist_rx:
        reason = F.when(~url.rlike(f"(?i){options.url_whitelist_rx}"), "not whitelisted").otherwise(reason)
    return reason


def scheme_allowed(url: Column, protocols: tuple[str, ...]) -> Column:
    return urls.scheme(url).isin(*protocols)


def classify(links: DataFrame, tops: DataFrame, options: Options = Options()) -> DataFrame:
    """links (link and others) with host, host_id, clean_url, skip_reason."""
    parsed = links.withColumn("_parsed", urls.host_and_clean(F.col("link"))).select(*links.columns, F.col("_parsed.host").alias("host"), F.col("_parsed.clean").alias("clean_url"))
    out = _known_hosts(parsed, tops, options.match_domain).select(*links.columns, "host", "host_id", "clean_url")
    return out.withColumn("skip_reason", skip_reason(F.col("clean_url"), options))


def _candidates(links: DataFrame, field: DataFrame, blacklist: list[str], options: Options, seq: list[str]) -> DataFrame:
    """First arrival of each new clean URL u, with its simplified form s, and whether it is the first of a form not known (enqueue)."""
    ok = links.filter("host_id is not null and clean_url is not null and skip_reason is null")
    first = ok.groupBy(F.col("clean_url").alias("u")).agg(F.min(F.struct(*seq)).alias("seq"), F.max("host_id").alias("host_id"))
    fresh = first.join(field.select(F.col("url").alias("u")), "u", "left_anti")
    fresh = fresh.withColumn("s", urls.simplify(F.col("u"), blacklist) if options.comp_param else F.col("u"))
    fresh = materialize(fresh, "admission")
    # the first arrival of a form is a least value, so that a form that very many URLs share is summed where they are
    least = fresh.groupBy("s").agg(F.min(F.struct("seq", "u")).alias("_least"))
    least = least.join(field.select(F.col("url").alias("s")), "s", "left_anti").select(F.col("_least.u").alias("u"), F.lit(True).alias("_first"))
    return fresh.join(least, "u", "left").withColumn("enqueue", F.col("_first").isNotNull()).drop("_first")


def admit(links: DataFrame, field: DataFrame, blacklist: list[str] | None = None, options: Options = Options(), seq: tuple[str, ...] = ("page_id", "pos")) -> tuple[DataFrame, DataFrame]:
    """Admission of classified links (clean_url, host_id, skip_reason, seq columns) to field (url).

    Returns the admitted (url, host_id, seq columns) for the download queue, and the new rows of field (url, checked,
    is_phantom): a URL whose simplified form is known already, or came before, is checked at once and not queued; the
    simplified forms are inserted as checked phantoms.
    """
    rows = _candidates(links, field, blacklist or [], options, list(seq))
    admitted = rows.filter("enqueue").select(F.col("u").alias("url"), "host_id", *[F.col(f"seq.{c}").alias(c) for c in seq])
    own = rows.select(F.col("u").alias("url"), (~F.col("enqueue")).alias("checked"), F.lit(False).alias("is_phantom"))
    phantoms = rows.filter("s <> u").select(F.col("s").alias("url")).distinct().join(field.select("url"), "url", "left_anti")
    phantoms = phantoms.join(own.select("url"), "url", "left_anti").select("url", F.lit(True).alias("checked"), F.lit(True).alias("is_phantom"))
    return admitted, own.unionByName(phantoms)


def prefixes(admitted: DataFrame, seq: tuple[str, ...] = ("page_id", "pos")) -> DataFrame:
    """(url, seq columns, _i, _prefix): the proper prefixes of each URL, by number of segments and hash."""
    rows = admitted.withColumn("_segs", urls.segments(F.col("url"))).filter(F.size("_segs") > 1)
    each = rows.select("url", *seq, F.explode(F.sequence(F.lit(1), F.size("_segs") - 1)).alias("_i"), "_segs")
    return each.select("url", *seq, "_i", F.xxhash64(F.slice("_segs", F.lit(1), F.col("_i"))).alias("_prefix"))


def prefix_counts(admitted: DataFrame) -> DataFrame:
    """(prefix, i, n): how many of the admitted URLs have each proper prefix. Counts of batches add up."""
    return prefixes(admitted, ()).groupBy(F.col("_prefix").alias("prefix"), F.col("_i").alias("i")).agg(F.count("*").alias("n"))


def novelty(admitted: DataFrame, seq: tuple[str, ...] = ("page_id", "pos"), earlier: DataFrame | None = None) -> DataFrame:
    """admitted with priority: 1 and, for each proper prefix of i segments, i times the earlier URLs that share it; times 100 with a query.

    earlier: prefix_counts() of all that was admitted in earlier rounds, which come first.

    Prefixes are keyed by their hash and length, which keeps the shuffled rows small. A prefix that many URLs share
    (all of one host) is ranked in two steps: within chunks of pages, then by the sum of earlier chunks. The admitted
    rows are used three times, so they are written once.
    """
    rows = materialize(admitted, "novelty")
    found = prefixes(rows, seq)
    chunk = F.floor(F.col(seq[0]) / 4096)
    inner = Window.partitionBy("_prefix", "_i", "_chunk").orderBy(*seq)
    ranked = found.withColumn("_chunk", chunk).withColumn("_rank", F.row_number().over(inner) - 1)
    sums = found.withColumn("_chunk", chunk).groupBy("_prefix", "_i", "_chunk").agg(F.count("*").alias("_n"))
    before = sums.withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy("_prefix", "_i").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    if earlier is not None:
        old = earlier.select(F.col("prefix").alias("_prefix"), F.col("i").alias("_i"), F.col("n").alias("_old"))
        before = before.join(old, ["_prefix", "_i"], "left").withColumn("_before", F.col("_before") + F.coalesce("_old", F.lit(0)))
    scored = ranked.join(before.select("_prefix", "_i", "_chunk", "_before"), ["_prefix", "_i", "_chunk"])
    total = scored.groupBy("url").agg(F.sum(F.col("_i") * (F.col("_rank") + F.col("_before"))).alias("_sum"))
    priority = (1 + F.coalesce("_sum", F.lit(0))) * F.when(F.contains("url", F.lit("?")), 100).otherwise(1)
    return rows.join(total, "url", "left").withColumn("priority", priority.cast("long")).drop("_sum")


def breadth(admitted: DataFrame, round_number: int) -> DataFrame:
    """admitted with the number of the round as priority."""
    return admitted.withColumn("priority", F.lit(round_number).cast("long"))


def holds(responses: DataFrame, now: int | Column, default: int | None = None, held: DataFrame | None = None) -> DataFrame:
    """(host_id, until) from responses (host_id, code, retry_after text): until is the latest second a host is held.

    Only responses other than 200 count, with a retry_after of up to three digits, or 429 and the default. now: second
    of all responses, or a column with that of each. held: holds already there, of which the later counts.
    """
    seconds = F.when(F.col("retry_after").rlike("^[0-9]{1,3}$"), F.col("retry_after").try_cast("int"))
    if default is not None:
        seconds = F.when(F.col("retry_after").isNull() & (F.col("code") == 429), default).otherwise(seconds)
    rows = responses.filter("code <> 200 and host_id is not null").withColumn("_s", seconds).filter("_s is not null")
    rows = rows.select("host_id", (F.col("_s") + now).cast("long").alias("until"))
    rows = rows if held is None else rows.unionByName(held.select("host_id", F.col("until").cast("long").alias("until")))
    return rows.groupBy("host_id").agg(F.max("until").alias("until"))


def next_wait(held: DataFrame, now: int) -> DataFrame:
    """(wait): seconds until the first hold that is not over ends, at least 1; null without a hold."""
    return held.filter(F.col("until") >= now).agg(F.greatest(F.min("until") - now, F.lit(1)).alias("_w"), F.count("*").alias("_n")).select(F.when(F.col("_n") > 0, F.col("_w")).cast("long").alias("wait"))


def available(queue: DataFrame, held: DataFrame, now: int) -> DataFrame:
    """Rows of the queue whose host is not held now."""
    active = held.filter(F.col("until") >= now).select("host_id").distinct()
    return queue.join(sized(active), "host_id", "left_anti").select(*queue.columns)


def schedule(queue: DataFrame, held: DataFrame, now: int) -> DataFrame:
    """The available queue with rank: the place among its host's URLs by priority, then id. Fair order: rank, host_id.

    A URL's rank is its place in its host and priority, counted by chunks of ids, and the number of its host's URLs of
    smaller priorities: no task gets all URLs of a host.
    """
    rows = materialize(available(queue, held, now).withColumns({"_host": F.coalesce("host_id", F.lit(-1)), "_one": F.lit(1).cast("long")}), "schedule")
    counts = rows.groupBy("_host", "priority").agg(F.count("*").alias("_n"))
    before = scanned(counts, ["_host"], ["priority"], *bounds(rows, "priority"), sums=("_n",)).select("_host", "priority", F.col("sum__n").alias("_before"))
    placed = scanned(rows, ["_host", "priority"], ["url_id"], *bounds(rows, "url_id"), sums=("_one",), bits=16)
    rank = (F.col("_before") + F.col("sum__one") + 1).cast("int")
    return placed.join(before, ["_host", "priority"]).select(*queue.columns, rank.alias("rank"))


def releases(events: DataFrame) -> DataFrame:
    """(host_id, url_id, priority, released) of events (host_id, second, url_id, priority, until): when each URL is free to
    be fetched.

    An event with a url_id queues it, at its second; one without holds its host until a second, that included. Holds that
    begin before the one before has ended make one stretch. A URL that comes in a stretch is released in the second
    after it, any other when it comes. Of one second holds come first.

    Both windows are cut into chunks of seconds, so that no task holds all events of a host.
    """
    events = events.filter("host_id is not null and second is not null")
    holds = events.filter("url_id is null and until >= second").groupBy("host_id", F.col("second").cast("long").alias("second")).agg(F.max("until").cast("long").alias("_hold"))
    holds = holds.withColumn("_least", -F.col("_hold"))
    low, high = bounds(holds, "second")
    holds = scanned(holds, ["host_id"], ["second"], low, high, mins=("_least",))
    begins = F.when(F.coalesce(-F.col("min__least"), F.col("second") - 1) < F.col("second"), 1).otherwise(0).cast("long")
    holds = holds.select("host_id", "second", F.lit(0).alias("_kind"), F.lit(None).cast(events.schema["url_id"].dataType).alias("url_id"), F.lit(None).cast(events.schema["priority"].dataType).alias("priority"), "_hold", begins.alias("_begins"))
    urls_ = events.filter("url_id is not null").select("host_id", F.col("second").cast("long").alias("second"), F.lit(1).alias("_kind"), "url_id", "priority", F.lit(None).cast("long").alias("_hold"), F.lit(0).cast("long").alias("_begins"))
    rows = materialize(holds.unionByName(urls_), "releases")
    low, high = bounds(rows, "second")
    rows = scanned(rows, ["host_id"], ["second", "_kind"], low, high, sums=("_begins",)).withColumn("_stretch", F.col("sum__begins") + F.col("_begins"))
    ends = rows.filter("_kind = 0").groupBy("host_id", "_stretch").agg(F.max("_hold").alias("_end"))
    waiting = rows.filter("_kind = 1").join(ends, ["host_id", "_stretch"], "left")
    return waiting.select("host_id", "url_id", "priority", F.when(F.col("_end") >= F.col("second"), F.col("_end") + 1).otherwise(F.col("second")).alias("released"))


def download_pop(queue: DataFrame, held: DataFrame, now: int, n: int) -> DataFrame:
    """The next n URLs in fair order. Only a host's first n can be among them, which Spark's group limit cuts early."""
    w = Window.partitionBy("host_id").orderBy("priority", "url_id")
    return available(queue, held, now).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n).orderBy("rank", "host_id").limit(n)


def parse_pop(queue: DataFrame, n: int, locality: DataFrame | None = None, instance_id: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The n pages of least id to parse, of one instance if given, and the queue that remains."""
    mine = queue
    if instance_id is not None and locality is not None:
        mine = queue.join(locality.filter(F.col("instance_id") == instance_id).select("url_id"), "url_id", "left_semi")
    taken = mine.orderBy("url_id").limit(n)
    return taken, queue.join(taken, "url_id", "left_anti")


def healthcheck(field: DataFrame, errors: DataFrame, tail: int = 100, threshold: int = 80, locality: DataFrame | None = None, instance_id: int | None = None) -> DataFrame:
    """(err_count, failed): errors among the URLs fetched last, by the instance if one is given. tail or threshold of 0 or less: never failed."""
    if instance_id is not None and locality is not None:
        field = field.join(locality.filter(F.col("instance_id") == instance_id).select(F.col("url_id").alias("id")), "id", "left_semi")
    last = field.filter("checkd is not null").orderBy(F.desc("checkd"), F.desc("id")).limit(max(tail, 0))
    n = last.join(errors.select(F.col("url_id").alias("id")).distinct(), "id", "left_semi").agg(F.count("*").alias("err_count"))
    return n.withColumn("failed", (F.col("err_count") >= threshold) & F.lit(tail > 0 and threshold > 0))


def healthcheck_due(done: int, tail: int = 100, interval: int = 100) -> bool:
    """Whether a healthcheck follows the done-th fetch: at every interval, once the tail is full. interval 0: never."""
    return interval > 0 and done >= tail and done % interval == 0


def mirror_healthcheck(results: DataFrame, threshold: int) -> DataFrame:
    """(done, errors, failed) of transfers (ok): failed if the percentage of errors reaches the threshold."""
    counted = results.agg(F.count("*").alias("done"), F.count_if(~F.col("ok")).alias("errors"))
    return counted.withColumn("failed", (F.col("done") > 0) & (100 * F.col("errors") >= threshold * F.col("done")))


def seed_hosts(seeds: DataFrame, protocols: tuple[str, ...] = ("http",)) -> DataFrame:
    """(hostname, url) of seeds (seed): a URL gives its host and itself, a host itself and one URL for each protocol."""
    is_url = F.col("seed").rlike("^https?://")
    made = F.when(is_url, F.array(urls.clean(F.col("seed")))).otherwise(F.array(*[F.concat(F.lit(f"{p}://"), F.col("seed")) for p in protocols]))
    return seeds.select(F.when(is_url, urls.host(F.col("seed"))).otherwise(F.lower("seed")).alias("hostname"), F.explode(made).alias("url")).distinct()


def seed(seeds: DataFrame, state: dict[str, DataFrame], protocols: tuple[str, ...] = ("http",), instance: str | None = None, match_domain: bool = False) -> dict[str, DataFrame]:
    """The state after seeding: new hosts in tops, new URLs in field and as nodes of depth 0, all unfetched URLs of known
    hosts in download_queue. With an instance, by its name, it is created if need be, and host_inst has all seeded hosts.

    Ids go on from the largest ones, in order of host names and URLs.
    """
    out, found = dict(state), materialize(seed_hosts(seeds, protocols), "seeds")
    hosts = found.select(urls.canonical_host(F.col("hostname"), match_domain).alias("hostname")).filter("hostname is not null").distinct()
    new_hosts = materialize(tables.numbered(hosts.join(state["tops"].select("hostname"), "hostname", "left_anti"), tables.last_id(state["tops"]) + 1, "hostname"), "seed-hosts")
    out["tops"] = state["tops"].unionByName(new_hosts.select("id", "hostname"))
    if instance:
        instances = state["instances"]
        if instances.filter(F.col("instance_name") == instance).isEmpty():
            one = instances.sparkSession.createDataFrame([(tables.last_id(instances) + 1, instance)], "id long, instance_name string")
            instances = out["instances"] = instances.unionByName(one)
        mine = out["tops"].join(hosts, "hostname").select(F.col("id").alias("host_id"), F.lit(tables.instance_id(instances, instance)).cast("long").alias("instance_id"))
        out["host_inst"] = tables.insert_new(state["host_inst"], mine, "host_id", "instance_id")
    fresh = found.select("url").filter("url is not null").distinct().join(state["field"].select("url"), "url", "left_anti")
    fresh = materialize(tables.numbered(fresh, tables.last_id(state["field"]) + 1, "url"), "seed-urls")
    out["field"] = state["field"].unionByName(fresh.select("id", "url"), allowMissingColumns=True)
    out["nodes"] = state["nodes"].unionByName(fresh.select(F.col("id").alias("url_id"), F.lit(0).alias("depth")), allowMissingColumns=True)
    out["download_queue"] = seed_queue(out["field"], out["tops"], state["download_queue"], match_domain)
    return out


def seed_queue(field: DataFrame, tops: DataFrame, queue: DataFrame, match_domain: bool = False) -> DataFrame:
    """queue with all unfetched URLs of known hosts, at priority 0."""
    todo = check_hosts(field.filter("checkd is null"), tops, match_domain, "url").filter("host_id is not null")
    return tables.insert_new(queue, todo.select(F.col("id").alias("url_id"), F.lit(0).cast("long").alias("priority"), "host_id"), "url_id")


def kick(field: DataFrame, parse_queue: DataFrame) -> DataFrame:
    """parse_queue with all fetched pages that were not parsed."""
    return tables.insert_new(parse_queue, field.filter("checkd is not null and parsed is null").select(F.col("id").alias("url_id")), "url_id")


def retry(field: DataFrame, errors: DataFrame, locality: DataFrame, content: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """field with failed URLs unfetched again, locality and content without them."""
    failed = errors.select("url_id").distinct()
    marked = field.join(failed.select(F.col("url_id").alias("id"), F.lit(True).alias("_failed")), "id", "left")
    again = marked.withColumn("checkd", F.when(F.col("_failed").isNull(), F.col("checkd"))).select(*field.columns)
    return again, tables.without(locality, "url_id", failed, "url_id"), tables.without(content, "url_id", failed, "url_id")


def retry_all(state: dict[str, DataFrame], match_domain: bool = False) -> dict[str, DataFrame]:
    """The state with failed URLs unfetched and in download_queue again, no errors, and parse_queue filled anew."""
    out = dict(state)
    out["field"], out["locality"], out["content"] = retry(state["field"], state["download_error"], state["locality"], state["content"])
    out["download_error"] = state["download_error"].limit(0)
    out["parse_queue"] = kick(out["field"], state["parse_queue"])
    out["download_queue"] = seed_queue(out["field"], state["tops"], state["download_queue"], match_domain)
    return out


def register_redirects(field: DataFrame, redirects: DataFrame) -> tuple[DataFrame, DataFrame]:
    """redirects (from_id, url) with known (whether field has the clean target) and target; and new targets (url) for field."""
    cleaned = redirects.withColumn("target", urls.clean_redirect(F.col("url"))).filter("target is not null")
    have = field.select(F.col("url").alias("target"), F.col("id").alias("to_id")).dropDuplicates(["target"])
    out = cleaned.join(have, "target", "left").withColumn("known", F.col("to_id").isNotNull())
    return out, out.filter("not known").select(F.col("target").alias("url")).distinct()


def follow_redirects(field: DataFrame, redirects: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of redirects (from_id, url): (from_id, target, to_id, known), field with the new targets, and redirect with the pairs."""
    out, targets = register_redirects(field, redirects)
    new = tables.numbered(targets, tables.last_id(field) + 1, "url")
    named = out.join(new.select(F.col("url").alias("target"), F.col("id").alias("_new")), "target", "left").withColumn("to_id", F.coalesce("to_id", "_new"))
    resolved = materialize(named.select("from_id", "target", "to_id", "known"), "redirects")
    return resolved, field.unionByName(new.select("id", "url"), allowMissingColumns=True), tables.insert_new(pairs, resolved.select("from_id", "to_id"), "from_id", "to_id")


def finish_pages(finished: DataFrame, field: DataFrame, parse_queue: DataFrame, locality: DataFrame, now, instance_id: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """field, parse_queue and locality after fetches (url_id, eff_id, has_body): both ids are checked, the effective one is
    queued if a body was kept; with an instance, the source's locality is set and the effective one's only if it had none.
    """
    done = finished.select(F.col("url_id").alias("id")).union(finished.select("eff_id")).distinct().withColumn("_done", F.lit(True))
    checked = field.join(done, "id", "left").withColumn("checkd", F.when(F.col("_done"), F.lit(now).cast(field.schema["checkd"].dataType)).otherwise(F.col("checkd"))).select(*field.columns)
    queued = tables.insert_new(parse_queue, finished.filter("has_body").select(F.col("eff_id").alias("url_id")), "url_id")
    if instance_id is None:
        return checked, queued, locality
    mine = F.lit(instance_id).cast("long").alias("instance_id")
    placed = tables.upsert_latest(locality, finished.select("url_id", mine).distinct(), [F.col("instance_id")], "url_id")
    return checked, queued, tables.insert_new(placed, finished.select(F.col("eff_id").alias("url_id"), mine), "url_id")


def fetch_errors(responses: DataFrame, errors: DataFrame, now) -> DataFrame:
    """errors with those of responses (url_id, code, phrase, curl_error, curl_message, cancelled): latest wins."""
    bad = responses.filter("not cancelled and (curl_error is not null or code <> 200)")
    rows = bad.select("url_id", F.coalesce("curl_error", "code").cast("int").alias("error_code"), F.when(F.col("curl_error").isNotNull(), F.col("curl_message")).otherwise(F.col("phrase")).alias("error_message"), F.lit(now).cast("timestamp_ntz").alias("failed"))
    return tables.upsert_latest(errors, rows, [F.desc("error_code")], "url_id")


def page_files(finished: DataFrame) -> DataFrame:
    """(url_id, headers_id, body_id): under which id headers and body are filed; the body goes if the target was known."""
    eff = F.coalesce("eff_id", "url_id")
    return finished.select("url_id", eff.alias("headers_id"), F.when(~F.col("known"), eff).alias("body_id"))
