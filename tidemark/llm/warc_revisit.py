"""Resolution of not-modified revisits in a web archive.

A revisit record says that a page had not changed: it has no body, only headers. It is
resolved by an as-of join: the latest full response of the same canonical URL that was
captured before it. If the validators agree (entity tags, else modification dates), the
revisit stands for that response's body under the response's headers, updated by those that
a not-modified answer is permitted to change.

One URL may have a third of all captures. Records are therefore not grouped by URL but
sorted by URL and time into ranges, which split a long history anywhere; each range carries
its latest response forward, and what a range inherits from the ranges before it is worked
out from one row a range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed

# Fixed value: headers that a not-modified answer may bring up to date.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
# Fixed value: query parameters that follow visitors and name no resource.
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid)(=|$)"

_HEADERS = "array<struct<name:string,value:string>>"


def canonical_url(url: Column) -> Column:
    """One spelling for URLs of one resource; NULL stays NULL.

    Scheme and "www." or "m." are left out, the host is in lower case and without a default
    port, the fragment and tracking parameters are dropped, the other parameters sorted, and
    slashes at the end of the path removed. What is no http(s) URL is only trimmed.
    """
    plain = F.regexp_replace(F.trim(url), r"#.*$", "")
    host = F.regexp_replace(F.regexp_replace(
        F.lower(F.regexp_extract(plain, r"^(?i:https?)://([^/?]*)", 1)),
        r"^(www|m)\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(plain, r"^(?i:https?)://[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(plain, r"\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    whole = F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&")))
                     .otherwise(F.lit("")))
    return F.when(plain.rlike(r"^(?i:https?)://"), whole).otherwise(plain)


def _header(headers: Column, name: str) -> Column:
    return F.get(F.filter(headers, lambda h: h["name"] == name), F.lit(0))["value"]


def _normal(headers: Column) -> Column:
    """Headers with names in lower case, sorted by name; lines of one name stay in their order."""
    low = F.transform(F.coalesce(headers, F.array().cast(_HEADERS)),
                      lambda h: F.struct(F.lower(h["name"]).alias("name"), h["value"].alias("value")))
    return _by_name(F.filter(low, lambda h: h["name"].isNotNull() & h["value"].isNotNull()))


def _by_name(headers: Column) -> Column:
    placed = F.array_sort(F.transform(headers, lambda h, at: F.struct(
        h["name"].alias("name"), at.alias("at"), h["value"].alias("value"))))
    return F.transform(placed, lambda h: F.struct(h["name"].alias("name"), h["value"].alias("value")))


def _once(rows: DataFrame, key: str) -> DataFrame:
    """One row for each key, the greatest; equal rows are combined in the map tasks."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max(F.struct(*rest)).alias("_row")).select(key, "_row.*")


def _latest(records: DataFrame) -> DataFrame:
    """Each record with the latest earlier response of its URL, as ``base_*`` columns."""
    order = ["url", "ts", "revisit", "record_id"]
    laid = checkpointed(records.repartitionByRange(*order).sortWithinPartitions(*order))
    responses = laid.where("NOT revisit AND url IS NOT NULL").withColumn(
        "p", F.spark_partition_id())
    ends = laid.where("url IS NOT NULL").groupBy(F.spark_partition_id().alias("p")).agg(
        F.min("url").alias("first"), F.max("url").alias("last"))
    at_end = responses.join(ends.select("p", F.col("last").alias("url")), ["p", "url"]).groupBy("p").agg(
        F.max(F.struct("ts", "record_id")).alias("latest"))
    latest = {r.p: r.latest.record_id for r in at_end.collect()}  # one row a range
    inherited, url, base = {}, None, None
    for r in sorted(ends.collect(), key=lambda r: r.p):
        if r.first == url and base is not None:
            inherited[r.p] = (url, base)
        base = latest.get(r.p, base if r.last == url else None)
        url = r.last

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_url, last_id = inherited.get(TaskContext.get().partitionId(), (None, None))
        for batch in batches:
            urls, ids = batch.column("url"), batch.column("record_id")
            full = ~batch.column("revisit").to_numpy(zero_copy_only=False)
            n = len(batch)
            # Position of the latest full response up to each row; -1 is what came before.
            at = np.maximum.accumulate(np.where(full, np.arange(n), -1)) if n else np.zeros(0, int)
            before = np.r_[[-1], at[:-1]] if n else at
            u, i = urls.to_pylist(), ids.to_pylist()
            base = []
            for k in range(n):
                of_url, of_id = (u[before[k]], i[before[k]]) if before[k] >= 0 else (last_url, last_id)
                base.append(of_id if u[k] is not None and of_url == u[k] else None)
            if n and at[-1] >= 0:
                last_url, last_id = u[at[-1]], i[at[-1]]
            yield batch.append_column("base_id", pa.array(base, ids.type))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in laid.schema)
    kind = laid.schema["record_id"].dataType.simpleString()
    return laid.mapInArrow(forward, f"{kinds}, base_id {kind}")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Every revisit with the response it stands for.

    ``records`` has ``record_id``, ``url``, ``ts``, ``revisit`` (NULL counts as
    false), ``headers`` (``array<struct<name, value>>``) and ``digest`` of the body; further
    columns are not read. Of revisits, or of responses, with one id one counts, so repeated
    rows are one. A name may have several header lines; a permitted header of the revisit
    takes the place of all lines of that name, and validators are compared by their first line. Returns ``record_id, url`` (canonical), ``ts, base_id, outcome,
    digest, headers``, one row a revisit. ``outcome`` is

    * ``resolved``: the validators agree, or neither side has one of a kind the other has;
      ``headers`` are those of the response, brought up to date;
    * ``mismatch``: they differ, so the body is not the one that was revisited;
    * ``orphan``: no earlier response; so too for a NULL URL or time.

    Unless resolved, ``digest`` is NULL and ``headers`` are the revisit's own. Entity tags are
    compared weakly (a leading ``W/`` aside) and decide where both sides have one; else the
    modification dates do. Of responses at one time the one with the greatest id is the latest;
    a response at the revisit's own time counts as earlier. An empty table gives an empty one.
    """
    plain = records.select(
        "record_id", canonical_url(F.col("url")).alias("url"), "ts",
        F.coalesce("revisit", F.lit(False)).alias("revisit"), "digest",
        _normal(F.col("headers")).alias("headers"))
    timed = plain.where("url IS NOT NULL AND ts IS NOT NULL")
    met = _once(_latest(timed.select("url", "ts", "revisit", "record_id")).where("revisit").select(
        "record_id", "base_id"), "record_id")
    revisits = _once(plain.where("revisit"), "record_id").join(met, "record_id", "left")
    # Copied by each revisit, a response may be wanted very often: joins of unique keys to
    # many rows, which adaptive execution splits.
    bases = _once(timed.where("NOT revisit").select(
        F.col("record_id").alias("base_id"), F.col("digest").alias("base_digest"),
        F.col("headers").alias("base_headers")), "base_id")
    both = revisits.join(bases, "base_id", "left")

    def agrees(name: str) -> Column:
        own, base = _header(F.col("headers"), name), _header(F.col("base_headers"), name)
        return F.regexp_replace(own, "^W/", "") == F.regexp_replace(base, "^W/", "")

    valid = F.coalesce(agrees("etag"), agrees("last-modified"), F.lit(True))
    outcome = F.when(F.col("base_id").isNull(), "orphan").when(valid, "resolved").otherwise("mismatch")
    newer = F.filter("headers", lambda h: h["name"].isin(*PERMITTED))
    kept = F.filter("base_headers", lambda b: ~F.exists(newer, lambda h: h["name"] == b["name"]))
    merged = _by_name(F.concat(kept, newer))
    return both.select(
        "record_id", "url", "ts", "base_id", outcome.alias("outcome"),
        F.when(outcome == "resolved", F.col("base_digest")).alias("digest"),
        F.when(outcome == "resolved", merged).otherwise(F.col("headers")).alias("headers"))


def headers_text(headers: Column) -> Column:
    return F.concat_ws("\n", F.transform(headers, lambda h: F.concat(h["name"], F.lit(": "), h["value"])))


def recrawl(pages: DataFrame) -> DataFrame:
    """A crawl's records derived from ``page_id, url, html``.

    Each page is captured in full at ten times its number. Its URL is asked for again five
    steps later and answered "not modified" with the page's entity tag (for every fifth page
    another, for every third a modification date alone), and once more some 40,000 steps
    later, by when the pages of one canonical URL have met.
    """
    n, tag = F.col("page_id"), F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit(""))), F.lit('"'))

    def header(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"))

    modified = header("Last-Modified", n)
    full = pages.select(
        (n * 4).alias("record_id"), "url", (n * 10).alias("ts"), F.lit(False).alias("revisit"),
        F.md5(F.coalesce("html", F.lit(""))).alias("digest"),
        F.array(header("Date", n * 10), header("ETag", tag), modified,
                header("Content-Length", F.char_length("html")), header("Cache-Control", F.lit("public")))
        .alias("headers"))

    def again(step: int, delay: int) -> DataFrame:
        sent = F.when(n % 3 == 0, F.array(modified)).when(
            n % 5 == 0, F.array(header("ETag", F.lit('"0"')))).otherwise(
            F.array(header("ETag", F.concat(F.lit("W/"), tag))))
        return pages.select(
            (n * 4 + step).alias("record_id"), "url", (n * 10 + delay).alias("ts"),
            F.lit(True).alias("revisit"), F.lit(None).cast("string").alias("digest"),
            F.concat(sent, F.array(header("Date", n * 10 + delay), header("Content-Length", F.lit(0)),
                                   header("Expires", n * 10 + delay + 100))).alias("headers"))

    return full.unionByName(again(1, 5)).unionByName(again(2, 40_003))
