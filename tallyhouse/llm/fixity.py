"""Merkle fixity audit of WARC records in two replicas.

Records are hashed; FANOUT neighbours in record order make a node of the next level, up to one root. A node's hash is that of its
children in order, each with its hash and the bytes it covers, which gives their offset ranges relative to the node. So a record
of another length changes the nodes above it, and no others. Roots are compared first, and only below nodes that
differ are the next nodes compared: sound parts of the archive cost one comparison each.

A leaf is the place of a record in the order in which the files hold them, counted over the records of both replicas, so a
lost record does not shift what follows it, and ids may be any longs, dense or thin. Places are counted in ranges of ids, whose
sizes are added up. Every level is one aggregation over a table a FANOUT-th as large as the one below; a group has FANOUT rows
at most. Records that share an id are folded to counts and sums of their digests, which needs no list of them.

Defined results: null urls and bodies are empty. Records with a null id are audited as those of one id, null, which comes first.
Repeated rows count: a record that one replica has twice and the other once differs. Empty replicas differ in nothing, or in
everything; empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import dropped, table, written

FANOUT = 16
#: Ids per WARC file, as a power of two.
FILE_BITS = 12


def records(pages: DataFrame) -> DataFrame:
    """(id, file, start, length, digest) of `pages` (page_id, url, html), each as a WARC response record in the file of its id."""
    body = F.coalesce("html", F.lit(""))
    record = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce("url", F.lit("")), F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"),
    )
    rows = pages.select(
        F.col("page_id").alias("id"), F.shiftright(F.col("page_id").cast("long"), FILE_BITS).alias("file"), F.octet_length(record).cast("long").alias("length"),
        F.sha2(record, 256).alias("digest"),
    )
    before = Window.partitionBy("file").orderBy("id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("start", F.coalesce(F.sum("length").over(before), F.lit(0)))


def _part(k: int):
    return F.conv(F.substring("digest", 15 * k + 1, 15), 16, 10).cast("decimal(38,0)")


def leaves(rows: DataFrame) -> DataFrame:
    """(id, hash, bytes): one per id."""
    return rows.groupBy("id").agg(
        F.sha2(F.concat_ws("/", F.count("*"), *(F.sum(_part(k)) for k in range(4))), 256).alias("hash"),
        F.sum("length").alias("bytes"),
    )


def places(ids: DataFrame, name: str) -> DataFrame:
    """(id, node): the places of the distinct `ids` in their order, from 0, written."""
    dealt = ids.select("id").distinct().repartitionByRange(F.asc_nulls_first("id")).withColumn("part", F.spark_partition_id())
    dealt = written(dealt, f"{name}-dealt")
    before = F.sum("m").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # a row per range of ids
    starts = dealt.groupBy("part").agg(F.count("*").alias("m")).withColumn("before", F.coalesce(before, F.lit(0)))
    number = F.row_number().over(Window.partitionBy("part").orderBy(F.asc_nulls_first("id"))) - 1
    found = written(dealt.withColumn("number", number).join(starts.select("part", "before"), "part").select("id", (F.col("before") + F.col("number")).alias("node")), name)
    dropped(dealt)
    return found


def levels(rows: DataFrame, order: DataFrame, height: int, name: str) -> list[DataFrame]:
    """The tree (node, hash, bytes) from its leaves to the root; `order` has the places of the ids, and level k has nodes of
    FANOUT**k places."""
    found = leaves(rows).withColumnRenamed("id", "own")
    out = [written(found.join(order, found["own"].eqNullSafe(order["id"])).select("node", "hash", "bytes"), f"{name}-0")]
    for k in range(1, height + 1):
        children = F.array_sort(F.collect_list(F.struct("node", "hash", "bytes")))
        up = out[-1].groupBy(F.expr(f"node div {FANOUT}").alias("parent")).agg(children.alias("c"))
        inside = F.transform("c", lambda x: F.concat_ws(":", x["node"], x["hash"], x["bytes"]))
        out.append(written(up.select(
            F.col("parent").alias("node"), F.sha2(F.array_join(inside, "/"), 256).alias("hash"),
            F.aggregate("c.bytes", F.lit(0).cast("long"), lambda a, x: a + x).alias("bytes"),
        ), f"{name}-{k}"))
    return out


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """Records that the replicas (see `records`) do not have the same number of times: id, digest, n_first, n_second, and the
    file and first offset in each."""
    order = places(first.select("id").unionByName(second.select("id")), "places")
    height = next(k for k in range(1, 20) if FANOUT**k >= order.count())
    one, two = levels(first, order, height, "first"), levels(second, order, height, "second")
    suspects = None
    for a, b in zip(reversed(one), reversed(two), strict=True):
        if suspects is not None:
            a, b = (x.withColumn("parent", F.expr(f"node div {FANOUT}")).join(suspects, "parent", "left_semi") for x in (a, b))
        nodes = a.select("node", F.col("hash").alias("x")).join(b.select("node", F.col("hash").alias("y")), "node", "full_outer")
        suspects = nodes.where(~F.col("x").eqNullSafe(F.col("y"))).select(F.col("node").alias("parent"))
    suspects = written(order.join(suspects, F.col("node") == F.col("parent"), "left_semi").select(F.col("id").alias("own"), F.col("node").alias("parent")), "suspects")
    dropped(order, *one, *two)

    def counts(rows: DataFrame, k: str) -> DataFrame:
        return rows.join(suspects, rows["id"].eqNullSafe(suspects["own"])).groupBy("parent", "id", "digest").agg(
            F.count("*").alias(f"n_{k}"), F.min("file").alias(f"file_{k}"), F.min("start").alias(f"start_{k}")
        )

    other = counts(second, "second").select(F.col("parent").alias("p"), F.col("id").alias("i"), F.col("digest").alias("d"), "n_second", "file_second", "start_second")
    found = counts(first, "first").join(other, (F.col("parent") == F.col("p")) & (F.col("digest") == F.col("d")), "full_outer")
    count = lambda k: F.coalesce(f"n_{k}", F.lit(0))
    return found.where(count("first") != count("second")).select(
        F.coalesce("id", "i").alias("id"), F.coalesce("digest", "d").alias("digest"),
        count("first").alias("n_first"), count("second").alias("n_second"), F.coalesce("file_first", "file_second").alias("file"),
        "start_first", "start_second",
    )


def damaged(pages: DataFrame) -> DataFrame:
    """The second replica of the query: some bodies altered, some records lost, some written twice, by id."""
    p = F.col("page_id")
    html = F.when(p % 89 == 7, F.concat(F.lit("�"), F.substring("html", 2, 1 << 30))).otherwise(F.col("html"))
    kept = pages.select("page_id", "url", html.alias("html")).where(F.coalesce(p % 233 != 11, F.lit(True)))
    return kept.withColumn("_n", F.explode(F.when(p % 307 == 13, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("_n")


def op2_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    first = written(records(pages), "records-first")
    second = written(records(damaged(pages)), "records-second")
    return audit(first, second).withColumnRenamed("id", "page_id")


def _sql(source: str, k: str) -> str:
    return rf"""{k}0 AS (SELECT page_id, floor(page_id / 4096)::BIGINT AS file,
  'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || coalesce(page_id::VARCHAR, 'none')
  || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Length: ' || octet_length(encode(coalesce(html, '')))
  || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record FROM {source}),
{k}1 AS (SELECT page_id, file, sha256(record) AS digest, octet_length(encode(record)) AS length FROM {k}0),
{k}2 AS (SELECT *, coalesce(sum(length) OVER (PARTITION BY file ORDER BY page_id, digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM {k}1),
{k} AS (SELECT page_id, digest, count(*) AS n, min(file) AS file, min(start) AS start FROM {k}2 GROUP BY ALL)"""


ORACLE = rf"""
WITH damaged AS (
  SELECT page_id, url, CASE WHEN page_id % 89 = 7 THEN chr(65533) || substr(html, 2) ELSE html END AS html
  FROM pages, (VALUES (1), (2)) AS t(c) WHERE page_id % 233 <> 11 AND (c = 1 OR page_id % 307 = 13)),
{_sql("pages", "a")}, {_sql("damaged", "b")}
SELECT coalesce(a.page_id, b.page_id) AS page_id, coalesce(a.digest, b.digest) AS digest, coalesce(a.n, 0) AS n_first, coalesce(b.n, 0) AS n_second,
  coalesce(a.file, b.file) AS file, a.start AS start_first, b.start AS start_second
FROM a FULL JOIN b ON a.page_id = b.page_id AND a.digest = b.digest WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)
"""
