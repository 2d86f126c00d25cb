"""The page store: annotation, volumes, ownership, mirror plans, dumps, purges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gossamr.operators import tables
from gossamr.operators.scan import BITS, bounds, scanned
from gossamr.sources import headers as headers_
from gossamr.sources import volumes
from gossamr.session import bucketed, materialize, sized
from gossamr.sources.options import Options


def annotate(field: DataFrame, bodies: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """(url_id, content_type, has_body, hash, siz) of fetched URLs that extra lacks. bodies: url_id, body, headers."""
    todo = field.filter("checkd is not null").select(F.col("id").alias("url_id"))
    if extra is not None:
        todo = todo.join(extra.select("url_id"), "url_id", "left_anti")
    rows = todo.join(bodies, "url_id", "left")
    kind = headers_.annotated_content_type(F.col("headers"))
    body = F.col("body").cast("binary")
    return rows.select("url_id", kind.alias("content_type"), F.col("body").isNotNull().alias("has_body"), F.sha1(body).alias("hash"), F.octet_length(body).cast("long").alias("siz"))


def duplicate_bodies(extra: DataFrame) -> DataFrame:
    """(hash, copies, first_id) of the bodies that several URLs share."""
    return extra.filter("hash is not null").groupBy("hash").agg(F.count("*").alias("copies"), F.min("url_id").alias("first_id")).filter("copies > 1")


def shard(url_id: Column) -> Column:
    return F.pmod(url_id, F.lit(1000))


def loose_path(url_id: Column, kind: str = "", schema: str | None = None, alternative: str | None = None) -> Column:
    """Path of a loose file: tmp/[schema/][alternative/]shard/id, with h for headers."""
    return F.concat(F.lit("/".join(["tmp", *filter(None, (schema, alternative))]) + "/"), shard(url_id).cast("string"), F.lit("/"), url_id.cast("string"), F.lit(kind))


def storage_url(root: str, url_id: Column, kind: str = "", schema: str | None = None) -> Column:
    """URL of a page, its headers (h) or a volume (.zip) on a storage server."""
    return F.concat(F.lit("/".join(filter(None, (root.rstrip("/"), schema))) + "/"), url_id.cast("string"), F.lit(kind))


def gzip_wanted(size: Column, accepts: Column, options: Options = Options()) -> Column:
    """Whether a response of so many bytes is to be compressed."""
    return (size >= options.compress_threshold) & (size <= options.no_compress_threshold) & F.coalesce(F.contains(accepts, F.lit("gzip")), F.lit(False))


#: Pointers that make one of the next length.
STEPS = 4


def _closing(ends: DataFrame, threshold: int) -> DataFrame:
    """(end): of the running totals of sizes (end: positive, each once) those at which a volume is closed.

    A volume that begins after the total x is closed by the first total past x + threshold. That is a pointer from each
    total to another one; which of them the chain from 0 goes through is found from pointers over 1, 4, 16, ... volumes,
    each kept only for totals that the pointers before it lead to, which are fewer each time; then the chain is filled in
    from the longest pointers to the shortest. So there are log(volumes) joins, of less and less rows.
    """
    n, total = ends.agg(F.count("*"), F.max("end")).first()
    if not n:
        return ends
    bits = max(BITS, (total // n).bit_length() + BITS)
    root = ends.sparkSession.createDataFrame([(0,)], "end long")
    asked = ends.unionByName(root).select((F.col("end") + threshold).alias("at"), F.lit(1).alias("asks"), F.col("end").alias("origin"), F.lit(None).cast("struct<at:bigint>").alias("found"))
    there = ends.select(F.col("end").alias("at"), F.lit(0).alias("asks"), F.lit(None).cast("long").alias("origin"), F.struct(F.col("end").alias("at")).alias("found"))
    pointers = scanned(asked.unionByName(there), [], ["at", "asks"], 0, total + threshold, nexts=("found",), bits=bits, above=BITS)
    pointers = materialize(pointers.filter("asks = 1 and next_found is not null").select(F.col("origin").alias("end"), F.col("next_found.at").alias("to")), "pack-pointers")
    lengths = []
    while True:
        rows, from_root = pointers.agg(F.count("*"), F.count_if(F.col("end") == 0)).first()
        if not from_root:
            break
        lengths.append(pointers)
        led = pointers.select(F.col("to").alias("end")).unionByName(root)
        ahead = sized(pointers.select(F.col("end").alias("to"), F.col("to").alias("further")), rows)
        steps = pointers.join(sized(led, rows + 1), "end", "left_semi")
        for _ in range(STEPS - 1):
            steps = steps.join(ahead, "to").select("end", F.col("further").alias("to"))
        pointers = materialize(steps, "pack-pointers")
    chain, links = root, 1
    for pointers in reversed(lengths):
        part, every = chain, chain
        for _ in range(STEPS - 1):
            part = pointers.join(sized(part, links), "end", "left_semi").select(F.col("to").alias("end"))
            every = every.unionByName(part)
        chain, links = materialize(every, "pack-chain"), STEPS * links
    return chain.filter("end > 0")


def pack(pages: DataFrame, threshold: int, first_volume: int = 1) -> DataFrame:
    """(url_id, volume_id) of pages (url_id, siz) in order of id: a volume is closed by the page that takes it over the threshold.

    Sizes are summed in order by chunks; where volumes close follows from the sums alone. A page's volume is the number
    of pages before it that close one. Null sizes count as 0.
    """
    sizes = pages.select("url_id", F.coalesce("siz", F.lit(0)).cast("long").alias("siz"))
    low, high = bounds(sizes, "url_id")
    ordered = scanned(sizes, [], ["url_id"], low, high, sums=("siz",)).select("url_id", F.when(F.col("siz") > 0, F.col("sum_siz") + F.col("siz")).alias("end"))
    ordered = materialize(ordered, "pack-ends")
    closing = _closing(ordered.filter("end is not null").select("end"), threshold).withColumn("closes", F.lit(1).cast("long"))
    marked = ordered.join(closing, "end", "left").select("url_id", F.coalesce("closes", F.lit(0)).cast("long").alias("closes"))
    return scanned(marked, [], ["url_id"], low, high, sums=("closes",)).select("url_id", (F.col("sum_closes") + first_volume).alias("volume_id"))


def close_volumes(content: DataFrame, pages: DataFrame, threshold: int) -> DataFrame:
    """(volume_id, pages, bytes, written): totals of volumes; those over the threshold are written."""
    return content.join(pages.select("url_id", "siz"), "url_id").groupBy("volume_id").agg(F.count("*").alias("pages"), F.sum("siz").alias("bytes")).withColumn("written", F.col("bytes") > threshold)


def finish_volumes(content: DataFrame, locality: DataFrame, closed: DataFrame, schema: str | None = None) -> tuple[DataFrame, DataFrame]:
    """locality without the pages of volumes just written (volume_id), and (path) of their loose files, that may go."""
    packed = content.join(closed.select("volume_id").distinct(), "volume_id", "left_semi").select("url_id")
    files = packed.select(F.explode(F.array(*[loose_path(F.col("url_id"), kind, schema) for kind in ("", "h")])).alias("path"))
    return tables.without(locality, "url_id", packed, "url_id"), files


def unpack(directory: DataFrame, content: DataFrame, volume_loc: DataFrame, locality: DataFrame, instance_id: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The four tables after written volumes (of the instance, if given) became loose pages again."""
    written = directory.filter("written is not null").select(F.col("id").alias("volume_id"))
    if instance_id is not None:
        written = written.join(volume_loc.filter(F.col("instance_id") == instance_id).select("volume_id"), "volume_id", "left_semi")
    moved = content.join(written, "volume_id", "left_semi")
    placed = locality
    if instance_id is not None:
        placed = tables.insert_new(locality, moved.select("url_id", F.lit(instance_id).cast("long").alias("instance_id")), "url_id")
    return tables.without(directory, "id", written, "volume_id"), content.join(written, "volume_id", "left_anti").select(*content.columns), volume_loc.join(written, "volume_id", "left_anti").select(*volume_loc.columns), placed


def volume_of(content: DataFrame, directory: DataFrame) -> DataFrame:
    """(url_id, volume_id) of pages in written volumes."""
    return content.join(directory.filter("written is not null").select(F.col("id").alias("volume_id")), "volume_id").select("url_id", "volume_id")


def ownership(field: DataFrame, errors: DataFrame, locality: DataFrame, me: int | None = None) -> DataFrame:
    """(id, is_local, is_remote) of URLs: fetched without error and of no instance or mine; or of others and not mine."""
    failed = errors.select(F.col("url_id").alias("id"), F.lit(True).alias("_failed")).dropDuplicates(["id"])
    where = locality.groupBy(F.col("url_id").alias("id")).agg(F.max("instance_id").alias("_some"), F.max(F.col("instance_id") == (me if me is not None else -1)).alias("_mine"))
    rows = field.join(failed, "id", "left").join(where, "id", "left")
    good = F.col("checkd").isNotNull() & F.col("_failed").isNull()
    local = good & (F.col("_some").isNull() if me is None else F.coalesce("_mine", F.lit(False)))
    remote = F.lit(False) if me is None else good & F.col("_some").isNotNull() & ~F.coalesce("_mine", F.lit(False))
    return rows.select("id", local.alias("is_local"), remote.alias("is_remote"))


def volume_ownership(directory: DataFrame, volume_loc: DataFrame, me: int | None = None) -> DataFrame:
    """As ownership(), for written volumes."""
    field = directory.select("id", F.col("written").alias("checkd"))
    none = volume_loc.select(F.col("volume_id").alias("url_id")).limit(0)
    return ownership(field, none, volume_loc.select(F.col("volume_id").alias("url_id"), "instance_id"), me)


def deletable(owned: DataFrame, content: DataFrame) -> DataFrame:
    """Ids that may be deleted here: owned by another instance, and not in a volume."""
    return owned.filter("is_remote").join(content.select(F.col("url_id").alias("id")), "id", "left_anti").select("id")


def sync_candidates(directory: DataFrame, volume_loc: DataFrame, field: DataFrame, errors: DataFrame, locality: DataFrame, remote: int | None, in_flight: DataFrame | None = None) -> DataFrame:
    """(kind, id, steps): written volumes at the remote instance, then its loose pages without error, less those in flight (kind, id); both by id."""
    packed = volume_ownership(directory, volume_loc, remote).filter("is_local").select(F.lit("volume").alias("kind"), "id", F.lit("body,ownership,delete").alias("steps"))
    pages = ownership(field, errors, locality, remote).filter("is_local").select(F.lit("page").alias("kind"), "id", F.lit("headers,body,ownership,delete").alias("steps"))
    both = packed.unionByName(pages)
    both = both if in_flight is None else both.join(in_flight, ["kind", "id"], "left_anti")
    return both.orderBy(F.desc("kind"), "id")


def connections(candidates: DataFrame, queued: int = 0) -> DataFrame:
    """(wanted): queued + 2 for each volume + 3 for each page."""
    return candidates.agg((F.lit(queued) + F.coalesce(F.sum(F.when(F.col("kind") == "volume", 2).otherwise(3)), F.lit(0))).alias("wanted"))


def dump(requested: DataFrame, field: DataFrame, errors: DataFrame, bodies: DataFrame, content: DataFrame | None = None, directory: DataFrame | None = None, part: str = "body") -> DataFrame:
    """(url, id, volume_id, status, body) of requested URLs: unknown, not downloaded, failed, no body, or ok.

    part: the column of bodies (url_id, body, headers) that is dumped, body or headers; without it the status names it.
    """
    rows = requested.join(field.select("url", "id", "checkd"), "url", "left")
    rows = rows.join(errors.select(F.col("url_id").alias("id"), F.lit(True).alias("_failed")).dropDuplicates(["id"]), "id", "left")
    rows = rows.join(bodies.select(F.col("url_id").alias("id"), F.col(part).alias("_part")), "id", "left")
    if content is not None and directory is not None:
        rows = rows.join(volume_of(content, directory).withColumnRenamed("url_id", "id"), "id", "left")
    else:
        rows = rows.withColumn("volume_id", F.lit(None).cast("long"))
    status = F.when(F.col("id").isNull(), "unknown").when(F.col("checkd").isNull(), "not downloaded").when(F.col("_failed"), "failed").when(F.col("_part").isNull(), f"no {part}").otherwise("ok")
    return rows.select("url", "id", "volume_id", status.alias("status"), F.col("_part").alias(part))


#: Columns by which tables refer to URLs.
URL_COLUMNS = {"edges": ("from_id", "to_id"), "redirect": ("from_id", "to_id"), "nodes": ("url_id",), "extra": ("url_id",), "parse_queue": ("url_id",), "content": ("url_id",), "download_error": ("url_id",), "download_queue": ("url_id",), "locality": ("url_id",), "field": ("id",)}


def purge(state: dict[str, DataFrame], ids: DataFrame) -> dict[str, DataFrame]:
    """All tables of the state without the URLs ids (id); edge_sets are rewritten, emptied volumes lose their places."""
    out = dict(state)
    for name, columns in URL_COLUMNS.items():
        for column in columns if name in out else ():
            out[name] = tables.without(out[name], column, ids)
    if "edge_sets" in out:
        out["edge_sets"] = purge_edge_sets(out["edge_sets"], ids)
    if {"volume_loc", "content"} <= out.keys():
        emptied = state["content"].select("volume_id").distinct().join(out["content"].select("volume_id"), "volume_id", "left_anti")
        out["volume_loc"] = tables.without(out["volume_loc"], "volume_id", emptied, "volume_id")
    return out


def purge_all(state: dict[str, DataFrame], archives: DataFrame, ids: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """purge() of the tables and volumes.purge_volumes() of the archives (volume_id, archive) in one: both without the
    URLs ids (id). Volumes left empty go from archives, directory and volume_loc.
    """
    left, emptied = volumes.purge_volumes(archives, state["content"], ids)
    out = purge(state, ids)
    for name, column in (("directory", "id"), ("volume_loc", "volume_id")):
        if name in out:
            out[name] = tables.without(out[name], column, emptied, "volume_id")
    return out, left


def edge_set_postings(edge_sets: DataFrame) -> DataFrame:
    """(member, row): which rows of edge_sets (by the hash of their sets) hold an id, on either side. From 5,000,000 rows
    on it is bucketed by member, so that purges look ids up without moving it.
    """
    rows = edge_sets.select(F.array_union("from_set", "to_set").alias("_members"), _row().alias("row"))  # hashed once a row, not once a member
    return bucketed(rows.select(F.explode("_members").alias("member"), "row"), "postings", "member")


def _row() -> Column:
    return F.xxhash64("to_set", "from_set")


def purge_edge_sets(edge_sets: DataFrame, ids: DataFrame, postings: DataFrame | None = None) -> DataFrame:
    """edge_sets (from_set, to_set; each to_set once) without the ids (id) on either side: emptied sets go, rows that come
    to have the children of another one merge with it.

    postings: edge_set_postings() of edge_sets, if they are kept. They tell which rows hold an id; only those are taken
    apart, and only those whose children another one now has are merged. All others stay as they are, and move only if
    the rows changed are too many to broadcast.
    """
    gone = materialize(ids.select(F.col("id").alias("member")).distinct(), "purge-ids")
    postings = edge_set_postings(edge_sets) if postings is None else postings
    hit = materialize(postings.join(sized(gone), "member", "left_semi").select(F.col("row").alias("_row")).distinct(), "purge-hit")
    rows = edge_sets.select("from_set", "to_set", _row().alias("_row"))
    touched, others = rows.join(sized(hit), "_row", "left_semi"), rows.join(sized(hit), "_row", "left_anti")
    gone = gone.withColumnRenamed("member", "_id")
    keep = lambda side: touched.select("_row", F.explode(side).alias("_id")).join(gone, "_id", "left_anti").groupBy("_row").agg(F.array_sort(F.collect_set("_id")).alias(side))
    merged = lambda df: df.groupBy("to_set").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("from_set")))).alias("from_set"))
    left = materialize(merged(keep("from_set").join(keep("to_set"), "_row")), "purge-left")
    have = sized(left.select("to_set"))
    meets, calm = others.join(have, "to_set", "left_semi"), others.join(have, "to_set", "left_anti")
    changed = merged(left.select("from_set", "to_set").unionByName(meets.select("from_set", "to_set")))
    return calm.select("from_set", "to_set").unionByName(changed.select("from_set", "to_set"))
